"""Is the label column a clean binary label?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.missing import quoted, share
from ..session import small_frame
from ..spec import LabelRule


def _text(rule: LabelRule) -> Column:
    return quoted(rule.column).cast("string")


def label_missing(rule: LabelRule) -> Column:
    return F.coalesce(_text(rule), F.lit("")) == ""


def label_valid(rule: LabelRule) -> Column:
    return F.coalesce(_text(rule).isin(*rule.allowed), F.lit(False))


def label_positive(rule: LabelRule) -> Column:
    return F.coalesce(_text(rule) == rule.positive, F.lit(False))


def label_negative(rule: LabelRule) -> Column:
    return label_valid(rule) & ~label_positive(rule)


def label_summary(df: DataFrame, rule: LabelRule) -> DataFrame:
    """One row: null, valid, invalid and positive counts and both positive shares.

    ``positive_share`` is over valid rows, ``positive_share_all`` over all rows.
    """
    if rule.column not in df.columns:
        counts = ("n_rows", "null_count", "valid_count", "invalid_count", "positive_count")
        return small_frame(
            df.sparkSession,
            [(rule.column, *[None] * (len(counts) + 2), "label column not found")],
            "column string, " + ", ".join(f"{c} bigint" for c in counts)
            + ", positive_share double, positive_share_all double, status string",
        )
    null, valid = label_missing(rule), label_valid(rule)
    one = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(null).alias("null_count"),
        F.count_if(valid).alias("valid_count"),
        F.count_if(~valid & ~null).alias("invalid_count"),
        F.count_if(label_positive(rule)).alias("positive_count"),
    )
    failed = F.lit(rule.fail_on_invalid) & (F.col("invalid_count") > 0)
    return one.select(
        F.lit(rule.column).alias("column"),
        "*",
        share(F.col("positive_count"), F.col("valid_count"), 0.0).alias("positive_share"),
        share(F.col("positive_count"), F.col("n_rows"), 0.0).alias("positive_share_all"),
        F.when(failed, "invalid_label_values").otherwise("ok").alias("status"),
    )


def class_counts(df: DataFrame, rule: LabelRule) -> DataFrame:
    """``(class, n)`` for every allowed class, zero included."""
    aggs = [F.count_if(_text(rule) == v).alias(f"n{i}") for i, v in enumerate(rule.allowed)]
    cells = [x for i, v in enumerate(rule.allowed) for x in (F.lit(v), F.col(f"n{i}"))]
    return df.agg(*aggs).select(F.stack(F.lit(len(rule.allowed)), *cells).alias("class", "n"))


def invalid_samples(df: DataFrame, rule: LabelRule) -> DataFrame:
    """The first invalid labels in value order, as many as the rule asks for."""
    bad = df.where(~label_valid(rule) & ~label_missing(rule))
    return bad.select(_text(rule).alias("label")).orderBy("label").limit(rule.sample_limit)
