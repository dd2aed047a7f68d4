"""Missing cells per column, and how a stage changed them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.missing import is_missing, share
from ..spec import AuditParams


def missingness(df: DataFrame, max_notice: float = AuditParams.max_missing_notice) -> DataFrame:
    """``(ordinal, column, n_rows, missing_count, missing_share, fully_missing, high_missing)``.

    One aggregate counts all columns in one scan; the single row is then
    turned into one row per column.
    """
    counts = [F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(df.columns)]
    cells = [x for i, c in enumerate(df.columns) for x in (F.lit(i), F.lit(c), F.col(f"m{i}"))]
    long = df.agg(F.count(F.lit(1)).alias("n_rows"), *counts).select(
        "n_rows", F.stack(F.lit(len(df.columns)), *cells).alias("ordinal", "column", "missing_count")
    )
    n, m = F.col("n_rows"), F.col("missing_count")
    rate = share(m, n, 0.0)
    return long.select(
        "ordinal",
        "column",
        "n_rows",
        "missing_count",
        rate.alias("missing_share"),
        ((n > 0) & (m == n)).alias("fully_missing"),
        (rate >= max_notice).alias("high_missing"),
    )


def top_missing(report: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` columns with the largest missing share, ties in column order."""
    return report.orderBy(F.col("missing_share").desc(), "ordinal").limit(n)


def _exact_shares(df: DataFrame, name: str) -> DataFrame:
    ratio = F.col("missing_count") / F.nullif(F.col("n_rows"), F.lit(0))
    return missingness(df).select("column", F.coalesce(ratio, F.lit(0.0)).alias(name))


def missing_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """``(column, before, after, delta)`` for the columns of the later stage."""
    joined = _exact_shares(after, "a").join(_exact_shares(before, "b"), "column", "left")
    was, now = F.coalesce("b", F.lit(0.0)), F.col("a")
    return joined.select(
        "column",
        F.round(was, 6).alias("before"),
        F.round(now, 6).alias("after"),
        F.round(now - was, 6).alias("delta"),
    )
