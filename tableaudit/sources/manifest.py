"""What was read: files, sizes, digests and row counts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = 1 << 20
DIGESTS = "path string, md5 string"


def _digester():
    # Defined inside, so that it travels to the workers by value and they need
    # no copy of this package.
    chunk = CHUNK

    def md5_of(path: str) -> str:
        if path.startswith("file:/") and not path.startswith("file:///"):
            path = "file://" + path.removeprefix("file:")
        # Names that only Hadoop's connectors use for these stores.
        for hadoop, common in (("s3a://", "s3://"), ("s3n://", "s3://"), ("viewfs://", None), ("wasbs://", None)):
            if path.startswith(hadoop):
                if common is None:
                    raise ValueError(f"cannot read {path}: give its files by the scheme of the store behind it")
                path = common + path.removeprefix(hadoop)
        store, inside = fs.FileSystem.from_uri(path)
        digest = hashlib.md5()
        with store.open_input_stream(inside) as stream:
            while piece := stream.read(chunk):
                digest.update(piece)
        return digest.hexdigest()

    def digest_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pydict({"path": [path], "md5": [md5_of(path)]})

    return digest_files


def list_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``(path, file_size_bytes, modified_at)``; the contents are not read.

    ``path`` is the file's URI, spelled as in every other table scan.
    """
    return (
        spark.read.format("binaryFile")
        .load(list(paths))
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("length").alias("file_size_bytes"),
            F.col("modificationTime").alias("modified_at"),
        )
    )


def file_digests(files: DataFrame) -> DataFrame:
    """``(path, md5)``.  Files are spread over the tasks; a file streams through one."""
    width = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return files.select("path").repartition(width, "path").mapInArrow(_digester(), DIGESTS)


def row_counts(table: DataFrame) -> DataFrame:
    """``(path, n_rows)`` of a table that was read from files; reads no column."""
    return table.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def manifest(
    spark: SparkSession,
    paths: Sequence[str],
    table: DataFrame,
    dataset: str,
    source_version: str,
    run_id: str,
    reader_options: str | None = None,
) -> DataFrame:
    """One row per file of a table.  Both sides of the joins are one row per file."""
    files = list_files(spark, paths)
    return (
        files.join(file_digests(files), "path")
        .join(row_counts(table), "path", "left")
        .select(
            F.lit(dataset).alias("dataset"),
            "path",
            "file_size_bytes",
            "modified_at",
            "md5",
            F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
            F.lit(len(table.columns)).alias("n_cols"),
            F.lit(reader_options).cast("string").alias("reader_options"),
            F.lit(source_version).alias("source_version"),
            F.lit(run_id).alias("run_id"),
        )
    )
