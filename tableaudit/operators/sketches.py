"""Numeric profiles kept per file and merged on demand.

For each file and column the store holds one row: exact counts and moments, a
quantile sketch (KLL) and a sketch of the distinct values (HLL).  Rows of any
choice of files merge into their profile without reading the files again, so a
new file costs one scan of itself.  A file is known by path, size and time of
change; one that changed is read anew, and its older rows no longer count.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.missing import share
from ..session import path_exists, small_frame
from ..sources.manifest import list_files
from .counts import Numeric
from .profile import columns_of, quantile_name

# Size of the quantile sketch (rank error about 0.3 per cent) and of the distinct sketch (about 1.6 per cent).
KLL_SIZE, HLL_BITS = 1024, 12
FIGURES = (
    "count bigint, n_valid bigint, min double, max double, mean double, m2 double, kll binary, hll binary"
)
SCHEMA = f"path string, file_size_bytes bigint, modified_at timestamp, column string, type string, {FIGURES}"
_NAMES = [f.split()[0] for f in FIGURES.split(", ")]


def _figures(item: Numeric) -> dict[str, Column]:
    value = item.value.cast("double")
    n = F.count(value)
    return {
        "count": F.count(F.lit(1)),
        "n_valid": n,
        "min": F.min(value),
        "max": F.max(value),
        "mean": F.avg(value),
        "m2": F.var_pop(value) * n,
        "kll": F.when(n > 0, F.kll_sketch_agg_double(value, F.lit(KLL_SIZE))),
        "hll": F.when(n > 0, F.hll_sketch_agg(item.value if item.integral else value.cast("string"), F.lit(HLL_BITS))),
    }


def file_sketches(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(path, column, type, figures)`` of a table that was read from files; one scan, a row per file is moved."""
    columns = list(columns) if columns is not None else columns_of(df, "int", "float")
    items = [Numeric.of(df, c) for c in columns]
    aggs, cells = [], []
    for i, item in enumerate(items):
        cells += [F.lit(item.name), F.lit("int" if item.integral else "float")]
        for name, figure in _figures(item).items():
            aggs.append(figure.alias(f"{name}_{i}"))
            cells.append(F.col(f"{name}_{i}"))
    if not items:
        fields = SCHEMA.replace(" file_size_bytes bigint, modified_at timestamp,", "")
        return small_frame(df.sparkSession, [], fields)
    by_file = df.groupBy(F.col("_metadata.file_path").alias("path")).agg(*aggs)
    return by_file.select("path", F.stack(F.lit(len(items)), *cells).alias("column", "type", *_NAMES))


def stored_sketches(spark: SparkSession, store: str) -> DataFrame:
    """What the store holds; an absent store is an empty one."""
    if not path_exists(spark, store):
        return small_frame(spark, [], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(store)


_FILE = ["path", "file_size_bytes", "modified_at"]


def update_sketches(
    spark: SparkSession, paths: Sequence[str], store: str, columns: Sequence[str] | None = None
) -> int:
    """Add the sketches of those Parquet files that the store does not know as they are now; returns their number.

    Only those files are read.  An update that fails leaves the store as it was.
    """
    files = list_files(spark, paths)
    known = stored_sketches(spark, store).select(*_FILE).distinct()
    # One row per file on both sides.
    new = files.join(known, _FILE, "left_anti").collect()
    if not new:
        return 0
    rows = small_frame(spark, [tuple(r) for r in new], "path string, file_size_bytes bigint, modified_at timestamp")
    # Paths are listed as URIs, and read as names.
    table = spark.read.parquet(*sorted(unquote(r["path"]) for r in new))
    found = file_sketches(table, columns).join(F.broadcast(rows), "path")
    found.select(*[c.split()[0] for c in SCHEMA.split(", ")]).write.mode("append").parquet(store)
    return len(new)


def merged_profile(
    stored: DataFrame, files: DataFrame, quantiles: Sequence[float]
) -> DataFrame:
    """One row per column over the given ``files`` (path, file_size_bytes, modified_at), from their stored rows.

    Counts, extremes, mean and deviation are exact; distinct counts and quantiles
    are estimates.  A file that is not in the store adds nothing; a row that was
    stored twice counts once.
    """
    held = stored.join(F.broadcast(files.select(*_FILE)), _FILE, "left_semi").dropDuplicates([*_FILE, "column"])
    n = F.col("n_valid").cast("double")
    first = held.groupBy("column").agg(
        F.min("type").alias("type"),
        F.sum("count").alias("count"),
        F.sum("n_valid").alias("n_valid"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        (F.sum(F.col("mean") * n) / F.nullif(F.sum(n), F.lit(0.0))).alias("mean"),
        F.kll_merge_agg_double("kll").alias("kll"),
        F.hll_union_agg("hll").alias("hll"),
    )
    # Deviations from the common mean: those inside files, and those of the files' means.
    centre = first.select("column", F.col("mean").alias("centre"))
    gap = F.col("mean") - F.col("centre")
    spread = held.join(F.broadcast(centre), "column").groupBy("column").agg(
        F.sum(F.col("m2") + n * gap * gap).alias("m2")
    )
    free = F.nullif(F.col("n_valid") - 1, F.lit(0))
    some = F.col("n_valid") > 0
    grid = F.array(*[F.lit(float(q)) for q in quantiles])
    return (
        first.join(F.broadcast(spread), "column")
        .withColumn("__q", F.when(some, F.kll_sketch_get_quantile_double("kll", grid)))
        .select(
            "column",
            "type",
            "count",
            F.when(some, F.hll_sketch_estimate("hll")).otherwise(F.lit(0)).cast("bigint").alias("n_unique"),
            share(F.col("count") - F.col("n_valid"), F.col("count"), 0.0).alias("missing_share"),
            "min",
            "max",
            "mean",
            F.when(some, F.coalesce(F.sqrt(F.col("m2") / free), F.lit(0.0))).alias("std"),
            *[F.col("__q")[i].alias(quantile_name(q)) for i, q in enumerate(quantiles)],
        )
    )
