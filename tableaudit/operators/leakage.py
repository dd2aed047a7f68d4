"""Does a feature know the label?"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.missing import quoted
from ..functions.parsing import utc_instant, utc_of_text
from ..session import small_frame
from ..spec import AuditParams, LabelRule, TableSpec
from .counts import (
    Numeric,
    area_under_curve,
    bucket_sums,
    cells,
    counts_within,
    fetch_borders,
    level_counts,
    ranged_counts,
    with_names,
)
from .label import label_negative, label_positive, label_valid
from .roles import non_features, pattern_hits

# Buckets per column of the search for pure levels.
LEVEL_BUCKETS = 1 << 16
FINDING = "check string, column string, detail string, amount double"


def candidates(df: DataFrame, spec: TableSpec) -> list[str]:
    """Columns that are neither non-features nor free text."""
    skip = set(non_features(df.columns, spec)) | set(spec.with_role("text"))
    return [c for c in df.columns if c not in skip]


def keyword_hits(columns: Sequence[str], patterns: Sequence[str]) -> list[tuple[str, str]]:
    """Sorted distinct (column, pattern) pairs of suspicious names."""
    return pattern_hits(columns, patterns)


def keyword_report(df: DataFrame, columns: Sequence[str], patterns: Sequence[str]) -> DataFrame:
    """``(column, keyword, filled_rows)``: suspicious names and how much data they carry."""
    hits = keyword_hits(columns, patterns)
    if not hits:
        return small_frame(
            df.sparkSession, [], "column string, keyword string, filled_rows bigint"
        )
    names = sorted({c for c, _ in hits})
    aggs = [F.count(quoted(c)).alias(f"n{i}") for i, c in enumerate(names)]
    cells = [x for c, k in hits for x in (F.lit(c), F.lit(k), F.col(f"n{names.index(c)}"))]
    return df.agg(*aggs).select(
        F.stack(F.lit(len(hits)), *cells).alias("column", "keyword", "filled_rows")
    )


def _is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.NumericType, T.BooleanType))


def pure_levels(
    df: DataFrame,
    rule: LabelRule,
    columns: Sequence[str],
    min_support: int = AuditParams.min_support,
    buckets: int = LEVEL_BUCKETS,
) -> DataFrame:
    """``(column, level, support, class_only)``: levels seen with one class only.

    Null is a level of its own.  Rows with any other label add no support.
    All columns share one grouped count.  Before it, sums by bucket drop the
    levels whose whole bucket has too little support in either class: of columns
    with nearly as many levels as rows hardly any are shuffled, as long as the
    rows are fewer than ``buckets`` times the support.
    """
    columns = [c for c in columns if c != rule.column]
    if not columns:
        return small_frame(
            df.sparkSession,
            [],
            "column string, level string, support bigint, class_only string",
        )
    negative = rule.negatives[0] if len(rule.negatives) == 1 else "negative"
    tallies = {"n_pos": label_positive(rule), "n_neg": label_negative(rule)}
    long = cells(df, columns, tallies)
    # Below two, every level has enough.
    if min_support > 1:
        sums = bucket_sums(long, buckets, tallies)
        able = sums.where(F.greatest("n_pos", "n_neg") >= min_support)
        counts = with_names(counts_within(long, able, buckets, tallies), columns)
    else:
        counts = level_counts(df, columns, tallies)
    support = F.col("n_pos") + F.col("n_neg")
    pure = (F.col("n_pos") == 0) != (F.col("n_neg") == 0)
    return counts.where((support >= min_support) & pure).select(
        "column",
        "level",
        support.alias("support"),
        F.when(F.col("n_pos") > 0, rule.positive).otherwise(negative).alias("class_only"),
    )


def univariate_auc(df: DataFrame, rule: LabelRule, columns: Sequence[str]) -> DataFrame:
    """``(column, auc, auroc, n_pos, n_neg)`` of each numeric column against the label.

    ``auroc`` is the larger of the two directions.  If any label is null or
    not allowed the scan does not apply and every column gets null; so does a
    column with fewer than two values or with one class only.
    """
    columns = [c for c in columns if c != rule.column]
    schema = "column string, auc double, auroc double, n_pos bigint, n_neg bigint"
    if not columns:
        return small_frame(df.sparkSession, [], schema)
    numbers = df.select(
        *[
            quoted(c).cast("int").alias(c)
            if isinstance(df.schema[c].dataType, T.BooleanType)
            else quoted(c)
            for c in columns
        ],
        label_positive(rule).alias("__is_pos"),
        label_valid(rule).alias("__is_valid"),
    )
    items = [Numeric.of(numbers, c) for c in columns]
    extra = [F.count_if(~F.col("__is_valid")).alias("bad_labels")]
    row, borders = fetch_borders(numbers, items, extra)
    names = small_frame(df.sparkSession, [(c,) for c in columns], "column string")
    if row["bad_labels"]:
        nothing = [F.lit(None).cast(t).alias(n) for n, t in
                   (("auc", "double"), ("auroc", "double"), ("n_pos", "bigint"), ("n_neg", "bigint"))]
        return names.select("column", *nothing)
    counts = ranged_counts(
        numbers, items, borders, {"n_pos": F.col("__is_pos"), "n_neg": ~F.col("__is_pos")}
    )
    scored = with_names(area_under_curve(counts), columns)
    enough = (F.col("n_pos") + F.col("n_neg")) >= 2
    auc = F.round(F.when(enough, F.col("auc")), 6)
    both = F.round(F.when(enough, F.greatest("auc", F.lit(1.0) - F.col("auc"))), 6)
    # One row per column on both sides.
    return names.join(F.broadcast(scored), "column", "left").select(
        "column", auc.alias("auc"), both.alias("auroc"), "n_pos", "n_neg"
    )


def near_perfect(
    df: DataFrame,
    rule: LabelRule,
    columns: Sequence[str],
    threshold: float = AuditParams.auc_threshold,
) -> DataFrame:
    """The numeric columns whose AUC reaches the threshold in either direction."""
    return univariate_auc(df, rule, columns).where(F.col("auroc") >= threshold)


def future_dates(
    df: DataFrame,
    columns: Sequence[str],
    as_of: str,
    year_max: int = AuditParams.future_year_max,
) -> DataFrame:
    """``(column, future_year_gt, after_now)`` per date column, zeros included."""
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return small_frame(
            df.sparkSession, [], "column string, future_year_gt bigint, after_now bigint"
        )
    aggs, cells = [], []
    for i, name in enumerate(columns):
        aggs += [
            F.count_if(_late_year(df, name, year_max)).alias(f"y{i}"),
            F.count_if(_after(df, name, as_of)).alias(f"a{i}"),
        ]
        cells += [F.lit(name), F.col(f"y{i}"), F.col(f"a{i}")]
    return df.agg(*aggs).select(
        F.stack(F.lit(len(columns)), *cells).alias("column", "future_year_gt", "after_now")
    )


def _late_year(df: DataFrame, name: str, year_max: int) -> Column:
    return _instant(df, name) >= utc_instant(F.lit(f"{year_max + 1:04d}-01-01"))


def _after(df: DataFrame, name: str, as_of: str) -> Column:
    return _instant(df, name) > utc_of_text(F.lit(as_of))


def _out_of_order(df: DataFrame, first: str, second: str) -> Column:
    return _instant(df, second) < _instant(df, first)


def _instant(df: DataFrame, name: str) -> Column:
    """The cell as an instant; what has no zone is UTC, whatever the session's zone."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return utc_of_text(quoted(name))
    if isinstance(dtype, (T.DateType, T.TimestampNTZType)):
        return utc_instant(quoted(name))
    return quoted(name).cast("timestamp")


def date_order(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``(first, second, violations)``: rows in which the second date comes first."""
    pairs = [(a, b) for a, b in pairs if a in df.columns and b in df.columns]
    if not pairs:
        return small_frame(
            df.sparkSession, [], "first string, second string, violations bigint"
        )
    aggs = [
        F.count_if(_out_of_order(df, a, b)).alias(f"v{i}") for i, (a, b) in enumerate(pairs)
    ]
    cells = [x for i, (a, b) in enumerate(pairs) for x in (F.lit(a), F.lit(b), F.col(f"v{i}"))]
    return df.agg(*aggs).select(
        F.stack(F.lit(len(pairs)), *cells).alias("first", "second", "violations")
    )


def leakage_findings(
    df: DataFrame,
    spec: TableSpec,
    params: AuditParams,
    as_of: str,
    include_label: bool = False,
    all_auc: bool = False,
) -> DataFrame:
    """Every finding of every scan as ``(check, column, detail, amount)``.

    The label itself is left out of the name scan unless ``include_label``;
    ``all_auc`` also lists the columns below the AUC threshold, as check
    ``auc``.
    """
    rule = params.label or LabelRule(spec.label)
    features = candidates(df, spec)
    numeric = [c for c in features if _is_numeric(df, c)]
    levels = [c for c in features if not _is_numeric(df, c)]
    scanned = [c for c in df.columns if include_label or c != rule.column]
    parts = [
        small_frame(
            df.sparkSession,
            [("keyword", c, k, None) for c, k in keyword_hits(scanned, params.leakage_keywords)],
            FINDING,
        ),
    ]
    if levels:
        parts.append(
            pure_levels(df, rule, levels, params.min_support).select(
                F.lit("pure_level").alias("check"),
                "column",
                F.concat(
                    F.coalesce(F.col("level"), F.lit("<null>")), F.lit(" -> "), F.col("class_only")
                ).alias("detail"),
                F.col("support").cast("double").alias("amount"),
            )
        )
    if numeric:
        auc = univariate_auc(df, rule, numeric).where(F.col("auroc").isNotNull())
        strong = F.col("auroc") >= params.auc_threshold
        if not all_auc:
            auc = auc.where(strong)
        parts.append(
            auc.select(
                F.when(strong, "near_perfect_auc").otherwise("auc").alias("check"),
                "column",
                F.lit(None).cast("string").alias("detail"),
                F.col("auroc").alias("amount"),
            )
        )
    dates = [c for c in spec.with_role("date") if c in df.columns]
    pairs = [p for p in params.date_order_pairs if p[0] in df.columns and p[1] in df.columns]
    if dates or pairs:
        parts.append(_date_findings(df, dates, pairs, as_of, params.future_year_max))
    return reduce(DataFrame.unionByName, parts)


def _date_findings(df: DataFrame, dates, pairs, as_of: str, year_max: int) -> DataFrame:
    """The date checks that found something, all counted in one scan."""
    checks = []
    for name in dates:
        checks.append(("future_year", name, None, _late_year(df, name, year_max)))
        checks.append(("after_now", name, None, _after(df, name, as_of)))
    for first, second in pairs:
        checks.append(("date_order", first, second, _out_of_order(df, first, second)))
    cells = [
        x
        for i, (check, name, detail, _) in enumerate(checks)
        for x in (F.lit(check), F.lit(name), F.lit(detail).cast("string"), F.col(f"n{i}"))
    ]
    counted = df.agg(*[F.count_if(c[3]).cast("double").alias(f"n{i}") for i, c in enumerate(checks)])
    return counted.select(
        F.stack(F.lit(len(checks)), *cells).alias("check", "column", "detail", "amount")
    ).where("amount > 0")


def suspect_features(findings: DataFrame) -> DataFrame:
    """Distinct columns with a pure level or a near-perfect AUC, in order."""
    return (
        findings.where(F.col("check").isin("pure_level", "near_perfect_auc"))
        .select("column")
        .distinct()
        .orderBy("column")
    )


def leakage_status(findings: DataFrame) -> DataFrame:
    """One row: how many findings, and whether anyone has to look at them."""
    real = F.count_if(F.col("check") != "auc")
    return findings.agg(real.alias("n_findings")).select(
        "n_findings",
        F.when(F.col("n_findings") > 0, "needs_manual_review")
        .otherwise("no_leakage_detected")
        .alias("status"),
    )


def id_overlap(train: DataFrame, test: DataFrame, key: str) -> DataFrame:
    """One row: ids that occur in both parts, and how many rows they own.

    Both sides are reduced to one row per id before they meet, so a hot id is
    a single row in the join.
    """
    count = lambda part, name: part.groupBy(quoted(key).alias("id")).agg(
        F.count(F.lit(1)).alias(name)
    )
    shared = count(train, "train_rows").join(count(test, "test_rows"), "id")
    return shared.agg(
        F.count(F.lit(1)).alias("shared_ids"),
        F.coalesce(F.sum("train_rows"), F.lit(0)).alias("train_rows"),
        F.coalesce(F.sum("test_rows"), F.lit(0)).alias("test_rows"),
    )
