"""Delimited text with quoted line breaks, read in parallel.

A line break ends a record only outside quotes, which a reader in the middle of a
file cannot see.  But a line turns "inside" into "outside" or back exactly when it
holds an odd number of quotes.  So one look counts the odd lines of each split,
their running sum over a file's splits says how each split begins, and then every
split cuts its own records.  Only a record that runs across splits is put together
from pieces, at most two of each split.

Quotes must be written in the usual way: a cell with a quote is quoted, and its
quotes are doubled.  Lines end in LF or CRLF; a file whose first line ends in CRLF
has LF in its cells, as Spark reads it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import small_frame

# Encodings in which quotes, line feeds and carriage returns are the ASCII bytes.
ENCODINGS = ("UTF-8", "US-ASCII", "ISO-8859-1")
_SPLIT = ["file", "block"]
PIECES = "file string, block bigint, chain bigint, crlf boolean, first boolean, whole boolean, record binary"


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``(file, block, line)`` in the order of the file inside each split; a line break is LF alone."""
    return (
        spark.read.option("lineSep", "\n")
        .text(list(paths))
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("value").cast("binary").alias("line"),
        )
    )


def _odd(line: Column) -> Column:
    text = line.cast("string")
    quotes = F.octet_length(text) - F.octet_length(F.replace(text, F.lit('"'), F.lit("")))
    return (quotes % 2 == 1).cast("bigint")


def split_states(lines: DataFrame) -> list[tuple[str, int, bool, int, bool]]:
    """``(file, block, opens, chain, crlf)`` of each split: whether it begins inside quotes, the
    split in which that record began, and how the file's first line ends.  One row
    per split reaches the driver.
    """
    # A split is read by one task from its start, so its first line is the first that task meets.
    counted = lines.groupBy(*_SPLIT).agg(
        F.sum(_odd(F.col("line"))).alias("odd"), F.first(F.endswith("line", F.lit(b"\r"))).alias("crlf")
    )
    out, file, opens, chain, crlf = [], None, False, 0, False
    for row in sorted(counted.collect(), key=lambda r: (r["file"], r["block"])):
        if row["file"] != file:
            file, opens, chain, crlf = row["file"], False, row["block"], row["crlf"]
        out.append((file, row["block"], opens, chain, crlf))
        if row["odd"] or not opens:
            chain = row["block"]  # what is open at the end began here
        opens ^= row["odd"] % 2 == 1
    return out


def _cutter():
    # Defined inside, so that it travels to the workers by value and they need no copy of this package.
    names = [f.split()[0] for f in PIECES.split(", ")]
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.binary())

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The split at hand: its key, whether the next line is inside quotes, the record's
        # lines so far, where it began, and whether it is the file's first.
        split, inside, held, chain, crlf, first = None, False, [], None, False, False
        out: list[tuple] = []

        def close(whole: bool) -> None:
            out.append((*split, chain, crlf, first, whole and chain is None, b"\n".join(held)))

        for batch in batches:
            files, blocks, lines, opens, chains, ends = (c.to_pylist() for c in batch.columns)
            for i, line in enumerate(lines):
                if (files[i], blocks[i]) != split:
                    if held:
                        chain = split[1] if chain is None else chain
                        close(False)
                    split = files[i], blocks[i]
                    inside, held, crlf = opens[i], [], ends[i]
                    chain = chains[i] if inside else None
                    first = blocks[i] == 0
                held.append(line)
                if line.count(b'"') % 2:
                    inside = not inside
                if not inside:
                    close(True)
                    held, chain, first = [], None, False
            if len(out) >= 4096:
                yield batch_of(out)
                out.clear()
        if held:
            chain = split[1] if chain is None else chain
            close(False)
        if out:
            yield batch_of(out)

    return cut


def records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``(first, crlf, record)``: the records as bytes, with the CR of a CRLF after them; whether they open their file, and its line ends."""
    lines = _lines(spark, paths)
    states = small_frame(
        spark, split_states(lines), "file string, block bigint, opens boolean, chain bigint, crlf boolean"
    )
    # One row per split.  A split that is not known was cut differently from the first look: an error, not a guess.
    lost = F.raise_error(F.lit("the splits of a file changed between two looks")).cast("boolean")
    joined = lines.join(F.broadcast(states), _SPLIT, "left").select(
        *_SPLIT, "line", F.coalesce("opens", lost).alias("opens"), "chain", "crlf"
    )
    pieces = joined.mapInArrow(_cutter(), PIECES)
    whole = pieces.where("whole").select("first", "crlf", "record")
    # Pieces of one record, in the order of their splits.
    parts = (
        pieces.where("NOT whole")
        .groupBy("file", "chain")
        .agg(
            F.min_by("first", "block").alias("first"),
            F.max("crlf").alias("crlf"),
            F.array_sort(F.collect_list(F.struct("block", F.hex("record").alias("hex")))).alias("parts"),
        )
        .select("first", "crlf", F.unhex(F.array_join(F.transform("parts", lambda p: p["hex"]), "0A")).alias("record"))
    )
    return whole.unionAll(parts)


def read_records(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType,
    options: dict[str, str],
    header: bool,
    encoding: str,
) -> DataFrame:
    """The rows of delimited files whose cells may hold line breaks, with the cells of ``schema``."""
    if encoding not in ENCODINGS:
        raise ValueError(f"{encoding} cannot be cut by bytes; read it with multiline=True")
    found = records(spark, paths)
    text = F.col("record").cast("string") if encoding == "UTF-8" else F.decode("record", encoding)
    if encoding == "UTF-8":
        text = F.regexp_replace(text, "^\\x{FEFF}", "")
    # The CR at the end belongs to the line break; those inside are written as LF alone.
    plain = F.replace(F.regexp_replace(text, r"\r\z", ""), F.lit("\r\n"), F.lit("\n"))
    rows = found.select("first", F.when(F.col("crlf"), plain).otherwise(text).alias("record"))
    wanted = F.col("record") != ""
    if header:
        wanted = wanted & ~F.col("first")
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema)
    parsed = rows.where(wanted).select(F.from_csv("record", ddl, options).alias("row"))
    return parsed.select("row.*")
