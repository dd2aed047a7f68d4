"""Is a later stage of a table what the earlier reports say it is?"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.missing import is_missing, quoted
from ..functions.parsing import micros_of
from ..session import remove_folder, shared_folder, small_frame
from ..spec import AuditParams, LabelRule, TableSpec
from .conform import types_match
from .label import label_positive, label_summary
from .missingness import missingness

# Two hexadecimal pieces of a digest, each cut into three numbers of 20 bits.
PIECES = (1, 16)
PIECE_DIGITS = 15
DIGEST = "__row_digest"
SHIFTS = (40, 20, 0)
FIGURES = {
    "n_rows": "n_rows_match", "n_cols": "n_cols_match", "header_md5": "header_match",
    "content_hash": "content_hash_match",
}


def canonical_text(df: DataFrame, name: str) -> Column:
    """A cell as text; instants as microseconds in UTC, null and empty alike."""
    dtype = df.schema[name].dataType
    value = quoted(name)
    if isinstance(dtype, T.TimestampType):
        text = F.unix_micros(value).cast("string")
    elif isinstance(dtype, T.TimestampNTZType):
        text = micros_of(value).cast("string")
    elif isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        text = F.to_json(value)
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit(""))


def row_digest(df: DataFrame) -> Column:
    """md5 of all cells; each cell carries its length, so cells cannot run together."""
    cells = []
    for name in df.columns:
        text = canonical_text(df, name)
        cells += [F.length(text).cast("string"), F.lit(":"), text]
    return F.md5(F.concat(*cells))


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: ``(n_rows, n_cols, header_md5, content_hash)``.

    120 bits of the row digests are summed in pieces, so neither the order of
    the rows nor their split over files matters, but every row counts, copies
    included.  Each task sends one row of sums.  The sums hold for eight
    trillion rows; beyond that Spark raises an overflow error.
    """
    totals = df.select(row_digest(df).alias(DIGEST)).agg(*_hash_aggregates())
    return totals.select(
        "n_rows",
        F.lit(len(df.columns)).alias("n_cols"),
        F.lit(_header(df)).alias("header_md5"),
        "content_hash",
    )


def _header(df: DataFrame) -> str:
    return hashlib.md5("\n".join(df.columns).encode()).hexdigest()


def _hash_aggregates() -> list[Column]:
    """Row count and content hash, as aggregates over a frame with row digests."""
    piece = lambda start: F.conv(F.substring(DIGEST, start, PIECE_DIGITS), 16, 10).cast("bigint")
    sums = [
        F.coalesce(F.sum(F.shiftright(piece(start), shift).bitwiseAND(F.lit(0xFFFFF))), F.lit(0))
        for start in PIECES
        for shift in SHIFTS
    ]
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.concat_ws("-", *[x.cast("string") for x in sums]).alias("content_hash"),
    ]


def compare_fingerprints(now: DataFrame, stored: DataFrame) -> DataFrame:
    """One row of flags.  A figure the stored side lacks counts as a match."""
    tagged = now.select(*[F.col(c).cast("string").alias(c) for c in FIGURES]).withColumn(
        "side", F.lit("now")
    )
    kept = [
        F.col(c).cast("string").alias(c) if c in stored.columns else F.lit(None).cast("string").alias(c)
        for c in FIGURES
    ]
    both = tagged.unionByName(stored.select(*kept).withColumn("side", F.lit("stored")))
    pick = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c)))
    return both.agg(
        *[
            F.coalesce(pick("now", c) == pick("stored", c), F.lit(True)).alias(flag)
            for c, flag in FIGURES.items()
        ]
    )


def label_share_match(
    df: DataFrame, rule: LabelRule, profiled_share: float, atol: float = AuditParams.label_share_atol
) -> DataFrame:
    """One row: does the positive share over all rows equal the profiled one?"""
    now = label_summary(df, rule)
    exact = F.coalesce(
        F.col("positive_count") / F.nullif(F.col("n_rows"), F.lit(0)), F.lit(0.0)
    )
    return now.select(
        F.col("positive_share_all").alias("positive_share"),
        (F.abs(exact - F.lit(float(profiled_share))) <= atol).alias("label_share_match"),
    )


def missing_share_close(
    df: DataFrame, profiled: DataFrame, atol: float = AuditParams.missing_share_atol
) -> DataFrame:
    """One row: are all profiled missing shares ``(column, missing_share)`` still right?"""
    exact = F.col("missing_count") / F.nullif(F.col("n_rows"), F.lit(0))
    now = missingness(df).select("column", F.coalesce(exact, F.lit(0.0)).alias("now"))
    joined = profiled.select("column", "missing_share").join(now, "column", "left")
    gap = F.abs(F.coalesce("now", F.lit(0.0)) - F.col("missing_share"))
    return joined.agg(
        F.count(F.lit(1)).alias("columns_compared"),
        F.coalesce(F.bool_and(gap <= atol), F.lit(True)).alias("missing_share_close"),
    )


def write_read_back(df: DataFrame, path: str | None = None) -> DataFrame:
    """One row: write the table, read it again and compare the fingerprints.

    The copy goes to a new path in the shared folder.  It is compared at once
    and then removed, so the result holds one row of flags and no reference to it.
    """
    return copy_matches(df, df, path)


def copy_matches(df: DataFrame, expected: DataFrame, path: str | None = None) -> DataFrame:
    """The same with the rows that should be read back given apart."""
    return _copy_flags(df, fingerprint(expected), path)


def _copy_flags(df: DataFrame, stored: DataFrame, path: str | None = None) -> DataFrame:
    spark = df.sparkSession
    path = path or shared_folder(spark, "write-test")
    df.write.mode("errorifexists").option("compression", "snappy").parquet(path)
    try:
        flags = compare_fingerprints(fingerprint(spark.read.parquet(path)), stored).first()
    finally:
        remove_folder(spark, path)
    return small_frame(
        spark, [(True, *flags)], "write_ok boolean, " + ", ".join(f"{f} boolean" for f in FIGURES.values())
    )


def stage_facts(df: DataFrame, label: LabelRule | None = None) -> Row:
    """One scan, one row: fingerprint, positive labels and missing cells of every column."""
    aggs = [F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(df.columns)]
    if label is not None:
        aggs.append(F.count_if(label_positive(label)).alias("positive_count"))
    return df.withColumn(DIGEST, row_digest(df)).agg(*_hash_aggregates(), *aggs).first()


def sanity_flags(
    after: DataFrame,
    spec: TableSpec,
    params: AuditParams,
    profiled_share: float | None = None,
    profiled_missing: DataFrame | None = None,
    stored: DataFrame | None = None,
    write_test: bool = False,
) -> DataFrame:
    """``(flag, ok)``: every check of the stage comparison that has its input.

    A check without its input holds, as there is nothing it contradicts.  The
    stage is scanned once for all figures, and once more to write the copy; the
    figures are one row, whatever the size of the table.
    """
    spark = after.sparkSession
    label = params.label if params.label is not None and profiled_share is not None else None
    facts = stage_facts(after, label)
    n_rows = facts["n_rows"]
    print_now = small_frame(
        spark,
        [(n_rows, len(after.columns), _header(after), facts["content_hash"])],
        "n_rows bigint, n_cols int, header_md5 string, content_hash string",
    )
    flags: dict[str, bool] = {}
    if stored is not None:
        flags |= compare_fingerprints(print_now, stored).first().asDict()
    if label is not None:
        share = facts["positive_count"] / n_rows if n_rows else 0.0
        flags["label_share_match"] = abs(share - profiled_share) <= params.label_share_atol
    if profiled_missing is not None:
        now = {c: facts[f"m{i}"] / n_rows if n_rows else 0.0 for i, c in enumerate(after.columns)}
        # One row per column of the profile.
        flags["missing_share_close"] = all(
            abs(now.get(r["column"], 0.0) - r["missing_share"]) <= params.missing_share_atol
            for r in profiled_missing.select("column", "missing_share").collect()
        )
    if write_test:
        flags["write_clean_ok"] = all(_copy_flags(after, print_now).first())
    flags["read_clean_ok"] = n_rows >= 0
    flags["schema_types_match"] = types_match(after, spec)
    return small_frame(spark, list(flags.items()), "flag string, ok boolean")
