"""Whom to contact: thresholds of a score, their cost and their yield.

All reports come from value counts in ranges of the score: sums from the highest
score down are running sums inside a range plus one row per range, so no task
sorts the whole table and a score that fills a third of it is one row.  Rows of
one score stand together: they are contacted all or none.

Only rows with an allowed label count.  Rows without a score cannot be contacted;
they stay in the number of rows and of positives.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.missing import missing_value, quoted
from ..session import small_frame
from ..spec import LabelRule
from .counts import Numeric, fetch_borders, ranged_counts
from .label import label_positive, label_valid

FIGURES = "contacted bigint, positives bigint, contact_rate double, precision double, recall double"


def _labelled(df: DataFrame, score: str, rule: LabelRule) -> DataFrame:
    return df.where(label_valid(rule)).select(quoted(score).alias("score"), label_positive(rule).alias("__is_pos"))


def _figures(contacted: Column, positives: Column, rows: int, all_positives: int) -> list[Column]:
    return [
        contacted.alias("contacted"),
        positives.alias("positives"),
        F.round(contacted / F.lit(rows), 6).alias("contact_rate"),
        F.round(positives / F.nullif(contacted, F.lit(0)), 6).alias("precision"),
        F.round(positives / F.nullif(F.lit(all_positives), F.lit(0)), 6).alias("recall"),
    ]


def _sweep(rows: DataFrame, buckets: int | None = None) -> tuple[DataFrame, int, int]:
    """(threshold, contacted, positives) of every distinct score, and the number of rows and positives."""
    items = [Numeric.of(rows, "score")]
    extra = [F.count(F.lit(1)).alias("rows"), F.count_if("__is_pos").alias("positives")]
    sizes, borders = fetch_borders(rows, items, extra, buckets)
    counts = ranged_counts(rows, items, borders, {"n_pos": F.col("__is_pos")})
    downward = [F.col("whole").desc_nulls_last(), F.col("fraction").desc_nulls_last()]
    inside = W.partitionBy("range").orderBy(*downward).rowsBetween(W.unboundedPreceding, 0)
    per_range = counts.groupBy("range").agg(F.sum("n").alias("n"), F.sum("n_pos").alias("n_pos"))
    # One row per range from here on.
    above = W.partitionBy(F.lit(0)).orderBy(F.col("range").desc()).rowsBetween(W.unboundedPreceding, -1)
    before = per_range.select(
        "range",
        *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in ("n", "n_pos")],
    )
    swept = counts.join(F.broadcast(before), "range").select(
        F.coalesce(F.col("whole").cast("double"), F.col("fraction")).alias("threshold"),
        (F.sum("n").over(inside) + F.col("n_above")).alias("contacted"),
        (F.sum("n_pos").over(inside) + F.col("n_pos_above")).alias("positives"),
    )
    return swept, sizes["rows"], sizes["positives"]


def threshold_curve(df: DataFrame, score: str, rule: LabelRule, buckets: int | None = None) -> DataFrame:
    """One row per distinct score: the figures of contacting everyone from it upwards."""
    swept, rows, positives = _sweep(_labelled(df, score, rule), buckets)
    return swept.select("threshold", *_figures(F.col("contacted"), F.col("positives"), max(rows, 1), positives))


def threshold_table(
    df: DataFrame, score: str, rule: LabelRule, rates: Sequence[float], buckets: int | None = None
) -> DataFrame:
    """One row per contact budget (a share of the rows): the lowest threshold within it, and its figures.

    A budget smaller than the number of rows with the highest score contacts
    nobody and has no threshold.
    """
    schema = f"rate double, threshold double, {FIGURES}"
    swept, rows, positives = _sweep(_labelled(df, score, rule), buckets)
    if not rates or not rows:
        nothing = (None, 0, 0, None, None, None)
        return small_frame(df.sparkSession, [(float(r), *nothing) for r in rates], schema)
    best = [
        F.max(
            F.when(
                F.col("contacted") <= math.floor(rate * rows),
                F.struct("contacted", "positives", "threshold"),
            )
        ).alias(f"b{i}")
        for i, rate in enumerate(rates)
    ]
    cells = [x for i, rate in enumerate(rates) for x in (F.lit(float(rate)), F.col(f"b{i}"))]
    # One row of bests becomes one row per rate.
    long = swept.agg(*best).select(F.stack(F.lit(len(rates)), *cells).alias("rate", "best"))
    zero = F.lit(0).cast("bigint")
    return long.select(
        "rate",
        F.col("best.threshold").alias("threshold"),
        *_figures(
            F.coalesce("best.contacted", zero), F.coalesce("best.positives", zero), rows, positives
        ),
    )


def threshold_metrics(df: DataFrame, score: str, rule: LabelRule, thresholds: Sequence[float]) -> DataFrame:
    """One row per given threshold, from one scan."""
    schema = f"threshold double, {FIGURES}"
    if not thresholds:
        return small_frame(df.sparkSession, [], schema)
    rows = _labelled(df, score, rule)
    scored = ~missing_value(F.col("score"), rows.schema["score"].dataType)
    cells = []
    aggs = [F.count(F.lit(1)).alias("rows"), F.count_if("__is_pos").alias("all_positives")]
    for i, threshold in enumerate(thresholds):
        reached = F.coalesce(scored & (F.col("score") >= F.lit(float(threshold))), F.lit(False))
        aggs += [F.count_if(reached).alias(f"n{i}"), F.count_if(reached & F.col("__is_pos")).alias(f"p{i}")]
        cells += [F.lit(float(threshold)), F.col(f"n{i}"), F.col(f"p{i}")]
    long = rows.agg(*aggs).select(
        "rows", "all_positives", F.stack(F.lit(len(thresholds)), *cells).alias("threshold", "contacted", "positives")
    )
    safe = lambda part, whole: F.round(part / F.nullif(whole, F.lit(0)), 6)
    return long.select(
        "threshold",
        "contacted",
        "positives",
        safe(F.col("contacted"), F.col("rows")).alias("contact_rate"),
        safe(F.col("positives"), F.col("contacted")).alias("precision"),
        safe(F.col("positives"), F.col("all_positives")).alias("recall"),
    )


def retain(df: DataFrame, score: str, threshold: float | None, column: str = "retain") -> DataFrame:
    """The input with a flag: whether the score reaches the agreed threshold; never null."""
    if threshold is None:
        return df.withColumn(column, F.lit(False))
    value = quoted(score)
    there = ~missing_value(value, df.schema[score].dataType)
    number = value if isinstance(df.schema[score].dataType, T.NumericType) else value.cast("double")
    return df.withColumn(column, F.coalesce(there & (number >= F.lit(float(threshold))), F.lit(False)))
