"""Profile of a free-text column."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.missing import quoted
from ..functions.text import search, word_count
from ..session import small_frame, staged
from ..spec import AuditParams
from .counts import (
    Numeric,
    exact_quantiles,
    ranged_counts,
    weighted_moments,
    with_names,
)
from .profile import quantile_name


def usable_patterns(patterns: Mapping[str, str]) -> dict[str, str]:
    """The patterns that compile; a broken one is skipped."""
    kept = {}
    for name, pattern in patterns.items():
        try:
            re.compile(pattern)
        except re.error:
            continue
        kept[name] = pattern
    return kept


def _text(column: str) -> Column:
    return F.coalesce(quoted(column).cast("string"), F.lit(""))


def _mean(flag: Column) -> Column:
    return F.avg(flag.cast("double"))


def text_shares(df: DataFrame, column: str, params: AuditParams = AuditParams()) -> DataFrame:
    """``(metric, number)``: empty share, personal-data shares, over-length share.

    One scan, one aggregate for all patterns.
    """
    text = _text(column)
    figures = {"empty_share": _mean(text == ""), "non_empty_share": _mean(text != "")}
    for name, pattern in usable_patterns(params.pii_patterns).items():
        figures[f"has_{name}_share"] = _mean(search(text, pattern))
    if params.text_len_warn is not None:
        figures["over_length_share"] = _mean(F.length(text) > int(params.text_len_warn))
    wide = df.agg(*[F.round(expr, 6).alias(name) for name, expr in figures.items()])
    cells = [c for name in figures for c in (F.lit(name), F.col(name))]
    return wide.select(F.stack(F.lit(len(figures)), *cells).alias("metric", "number"))


def text_lengths(
    df: DataFrame, column: str, quantiles=AuditParams.quantiles
) -> DataFrame:
    """``(length, metric, number)`` for characters and words, over all rows.

    Quantiles are cut to whole numbers.
    """
    text = _text(column)
    # Only the two lengths go on from the scan; texts are never shuffled.
    lengths = df.select(
        F.length(text).cast("bigint").alias("chars"), word_count(text).cast("bigint").alias("words")
    )
    items = [Numeric.of(lengths, "chars"), Numeric.of(lengths, "words")]
    names = [item.name for item in items]
    # There are no more distinct lengths than the longest text has characters,
    # however many rows there are, so one range per length will do.
    # They are read several times, and so written once: counting words is what costs here.
    counts = staged(ranged_counts(lengths, items, [[], []]), "length-counts")
    ends = small_frame(df.sparkSession, [(n,) for n in names], "column string").join(
        F.broadcast(with_names(weighted_moments(counts), names)), "column", "left"
    )
    zero = lambda end: F.coalesce(F.col(end).cast("bigint"), F.lit(0))
    cells = [x for end in ("min", "max") for x in (F.lit(end), zero(end))]
    titles = F.create_map(*[F.lit(x) for q in quantiles for x in (float(q), quantile_name(q))])
    inner = with_names(exact_quantiles(counts, quantiles), names)
    return ends.select(
        F.col("column").alias("length"), F.stack(F.lit(2), *cells).alias("metric", "number")
    ).unionByName(
        inner.select(
            F.col("column").alias("length"),
            F.element_at(titles, F.col("q")).alias("metric"),
            F.col("value").cast("bigint").alias("number"),
        )
    )


def text_profile(df: DataFrame, column: str, params: AuditParams = AuditParams()) -> DataFrame:
    """``(metric, number, warning)``: every figure about one free-text column."""
    if column not in df.columns:
        return df.agg(F.count(F.lit(1)).cast("double").alias("number")).select(
            F.lit("n_rows").alias("metric"),
            "number",
            F.lit(f"{column} column not found").alias("warning"),
        )
    shares = text_shares(df, column, params)
    lengths = text_lengths(df, column, params.quantiles).select(
        F.concat("length", F.lit("_"), "metric").alias("metric"),
        F.col("number").cast("double").alias("number"),
    )
    over = (F.col("metric") == "over_length_share") & (F.col("number") > 0)
    return shares.unionByName(lengths).withColumn(
        "warning", F.when(over, F.lit(f"length above {params.text_len_warn} characters"))
    )
