"""Column profiles: overview, numeric, categorical, date and boolean columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.missing import family, field_family, quoted, share
from ..session import small_frame
from ..spec import AuditParams
from .counts import (
    Numeric,
    bucket_sums,
    cells,
    counts_within,
    exact_quantiles,
    fetch_borders,
    level_counts,
    ranged_counts,
    weighted_moments,
    with_names,
)

# Buckets per text column, for reports that need only the frequent levels.
BUCKETS = 1 << 16
FAMILIES = ("int", "float", "bool", "category", "string", "datetime")
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def columns_of(df: DataFrame, *families: str) -> list[str]:
    return [f.name for f in df.schema if field_family(f) in families]


def quantile_name(q: float) -> str:
    return f"p{int(q * 100)}"


def overview(df: DataFrame) -> DataFrame:
    """``(family, n_columns, n_rows, n_cols)``, one row per type family."""
    found = [field_family(f) for f in df.schema]
    pairs = [c for f in FAMILIES for c in (F.lit(f), F.lit(found.count(f)))]
    rows = df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(found)).alias("n_cols"))
    return rows.select(
        F.stack(F.lit(len(FAMILIES)), *pairs).alias("family", "n_columns"), "n_rows", "n_cols"
    )


def numeric_profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    quantiles: Sequence[float] = AuditParams.quantiles,
    approx: bool = False,
) -> DataFrame:
    """One row per numeric column.

    Two scans: sketches for the range borders, then the value counts, from
    which every figure is exact.  With ``approx`` there is one scan, and the
    distinct counts and quantiles are estimates.
    """
    columns = list(columns) if columns is not None else columns_of(df, "int", "float")
    items = [Numeric.of(df, c) for c in columns]
    if approx:
        return _numeric_sketch(df, items, quantiles)
    row, borders = fetch_borders(df, items, [F.count(F.lit(1)).alias("rows")])
    n_rows = F.lit(row["rows"])
    names = small_frame(
        df.sparkSession,
        [(i.name, "int" if i.integral else "float") for i in items],
        "column string, type string",
    )
    counts = ranged_counts(df, items, borders)
    moments = with_names(weighted_moments(counts), columns)
    quantile_rows = with_names(exact_quantiles(counts, quantiles), columns)
    # From here on every frame has one row per column (times quantile).
    by_name = quantile_rows.groupBy("column").agg(
        *[
            F.max(F.when(F.col("q") == float(q), F.col("value"))).alias(quantile_name(q))
            for q in quantiles
        ]
    )
    valid = F.coalesce("n_valid", F.lit(0))
    return (
        names.join(F.broadcast(moments), "column", "left")
        .join(F.broadcast(by_name), "column", "left")
        .select(
            "column",
            "type",
            n_rows.cast("bigint").alias("count"),
            F.coalesce("n_unique", F.lit(0)).alias("n_unique"),
            share(n_rows - valid, n_rows, 0.0).alias("missing_share"),
            "min",
            "max",
            "mean",
            "std",
            *[quantile_name(q) for q in quantiles],
        )
    )


def _numeric_sketch(df: DataFrame, items: Sequence[Numeric], quantiles) -> DataFrame:
    """One scan; distinct counts and quantiles are estimates."""
    grid = F.array(*[F.lit(float(q)) for q in quantiles])
    aggs, figures_of = [F.count(F.lit(1)).alias("count")], []
    for i, item in enumerate(items):
        value = item.value.cast("double")
        figures = {
            "valid": F.count(value),
            "n_unique": F.approx_count_distinct(value),
            "min": F.min(value),
            "max": F.max(value),
            "mean": F.avg(value),
            "std": F.when(F.count(value) == 1, F.lit(0.0)).otherwise(F.stddev_samp(value)),
            "quantiles": F.percentile_approx(value, grid),
        }
        aggs += [expr.alias(f"{name}_{i}") for name, expr in figures.items()]
        figures_of += [F.lit(item.name), F.lit("int" if item.integral else "float")]
        figures_of += [F.col(f"{name}_{i}") for name in figures]
    long = df.agg(*aggs).select(
        "count", F.stack(F.lit(len(items)), *figures_of).alias("column", "type", *figures)
    )
    return long.select(
        "column",
        "type",
        "count",
        "n_unique",
        share(F.col("count") - F.col("valid"), F.col("count"), 0.0).alias("missing_share"),
        "min",
        "max",
        "mean",
        "std",
        *[F.col("quantiles")[i].alias(quantile_name(q)) for i, q in enumerate(quantiles)],
    )


def top_levels(
    df: DataFrame, columns: Sequence[str] | None = None, top_k: int = AuditParams.top_k
) -> DataFrame:
    """``(column, position, level, n, share)``: the most frequent levels.

    Ties are ordered by level.  Spark limits each partition to ``top_k`` rows
    per column before the shuffle, so no task sees all levels of a column.
    """
    columns = list(columns) if columns is not None else columns_of(df, "string", "category")
    return _top(_present(level_counts(df, columns)), top_k)


def _present(counts: DataFrame) -> DataFrame:
    """Without the missing levels.

    The test looks at the count as well, so it stays behind the grouping and
    the grouped counts are one plan for all their uses.
    """
    return counts.withColumn("n", F.when(F.col("level") != "", F.col("n"))).where("n > 0")


def _totals(levels: DataFrame) -> DataFrame:
    """One row per column."""
    return levels.groupBy("column").agg(
        F.sum("n").alias("n_valid"), F.count(F.lit(1)).alias("n_unique")
    )


def _top(levels: DataFrame, top_k: int) -> DataFrame:
    order = W.partitionBy("column").orderBy(F.col("n").desc(), "level")
    ranked = levels.withColumn("position", F.row_number().over(order)).where(
        F.col("position") <= top_k
    )
    return ranked.join(F.broadcast(_totals(levels)), "column").select(
        "column", "position", "level", "n", share(F.col("n"), F.col("n_valid")).alias("share")
    )


def categorical_profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    top_k: int = AuditParams.top_k,
    rare_level: float = AuditParams.rare_level,
) -> DataFrame:
    """One row per text column: distinct levels, top levels, rare and missing share."""
    columns = list(columns) if columns is not None else columns_of(df, "string", "category")
    field_of = {f.name: f for f in df.schema}
    counts = level_counts(df, columns)
    rows = counts.groupBy("column").agg(F.sum("n").alias("count"))
    levels = _present(counts)
    totals = _totals(levels)
    rare = (
        levels.join(F.broadcast(totals), "column")
        .groupBy("column")
        .agg(
            F.sum(F.when(F.col("n") / F.col("n_valid") < rare_level, F.col("n")).otherwise(0))
            .alias("n_rare"),
        )
    )
    top = (
        _top(levels, top_k)
        .groupBy("column")
        .agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("position", "level", "share"))),
                lambda t: F.struct(t["level"].alias("level"), t["share"].alias("share")),
            ).alias("top_levels")
        )
    )
    names = small_frame(
        df.sparkSession,
        [(c, field_family(field_of[c])) for c in columns],
        "column string, type string",
    )
    return (
        names.join(F.broadcast(rows), "column", "left")
        .join(F.broadcast(totals), "column", "left")
        .join(F.broadcast(rare), "column", "left")
        .join(F.broadcast(top), "column", "left")
        .select(
            "column",
            "type",
            F.coalesce("count", F.lit(0)).alias("count"),
            F.coalesce("n_unique", F.lit(0)).alias("n_unique"),
            "top_levels",
            share(F.col("n_rare"), F.col("n_valid"), 0.0).alias("rare_share"),
            share(F.col("count") - F.coalesce("n_valid", F.lit(0)), F.col("count"), 0.0).alias(
                "missing_share"
            ),
        )
    )


def rare_shares(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    rare_level: float = AuditParams.rare_level,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``(column, n_valid, frequent_levels, rare_share)``, with only the frequent levels shuffled.

    A level that is not rare owns ``rare_level`` of its column, and so does its
    bucket; there are at most ``1 / rare_level`` such buckets, whatever the
    number of levels.  The rare share is what the frequent levels leave.
    """
    columns = list(columns) if columns is not None else columns_of(df, "string", "category")
    long = cells(df, columns).where("level != ''")
    sums = bucket_sums(long, buckets)
    valid = sums.groupBy("slot").agg(F.sum("n").alias("n_valid"))
    heavy = sums.join(F.broadcast(valid), "slot").where(F.col("n") / F.col("n_valid") >= rare_level)
    frequent = (
        counts_within(long, heavy, buckets)
        .join(F.broadcast(valid), "slot")
        .where(F.col("n") / F.col("n_valid") >= rare_level)
        .groupBy("slot")
        .agg(F.sum("n").alias("n_frequent"), F.count(F.lit(1)).alias("frequent_levels"))
    )
    names = small_frame(df.sparkSession, list(enumerate(columns)), "slot int, column string")
    zero = F.lit(0).cast("bigint")
    rare = F.col("n_valid") - F.coalesce("n_frequent", zero)
    # One row per column.
    return (
        names.join(F.broadcast(valid), "slot", "left")
        .join(F.broadcast(frequent), "slot", "left")
        .select(
            "column",
            F.coalesce("n_valid", zero).alias("n_valid"),
            F.coalesce("frequent_levels", zero).alias("frequent_levels"),
            share(rare, F.col("n_valid"), 0.0).alias("rare_share"),
        )
    )


def top_levels_pruned(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    top_k: int = AuditParams.top_k,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``top_levels`` by bucket sums: levels proven out of the top are never shuffled.

    The levels of the heaviest buckets are counted first.  Their ``top_k``-th count
    is one that every level of the top reaches, so buckets below it are left out.
    Pays where a few levels stand above a long tail; in a column of nearly equal
    counts the bound is low and all levels are counted, as in ``top_levels``.
    """
    columns = list(columns) if columns is not None else columns_of(df, "string", "category")
    long = cells(df, columns).where("level != ''")
    sums = bucket_sums(long, buckets)
    valid = sums.groupBy("slot").agg(F.sum("n").alias("n_valid"))
    by_weight = W.partitionBy("slot").orderBy(F.col("n").desc(), "bucket")
    heaviest = sums.withColumn("place", F.row_number().over(by_weight)).where(F.col("place") <= 2 * top_k)
    by_count = W.partitionBy("slot").orderBy(F.col("n").desc(), "level")
    first = counts_within(long, heaviest, buckets).withColumn("place", F.row_number().over(by_count))
    bound = first.where(F.col("place") == top_k).select("slot", F.col("n").alias("least"))
    reach = sums.join(F.broadcast(bound), "slot", "left").where(F.col("n") >= F.coalesce("least", F.lit(0)))
    ranked = counts_within(long, reach, buckets).withColumn("position", F.row_number().over(by_count))
    named = with_names(
        ranked.where(F.col("position") <= top_k)
        .join(F.broadcast(valid), "slot")
        .select("slot", "position", "level", "n", share(F.col("n"), F.col("n_valid")).alias("share")),
        columns,
    )
    return named.select("column", "position", "level", "n", "share")


def _per_column(df: DataFrame, columns: Sequence[str], figures, schema_names) -> DataFrame:
    """One aggregate over all columns, turned into one row per column."""
    exprs, cells = [], []
    for i, name in enumerate(columns):
        cells.append(F.lit(name))
        for j, figure in enumerate(figures(name)):
            exprs.append(figure.alias(f"f{i}_{j}"))
            cells.append(F.col(f"f{i}_{j}"))
    wide = df.agg(F.count(F.lit(1)).alias("count"), *exprs)
    return wide.select("count", F.stack(F.lit(len(columns)), *cells).alias("column", *schema_names))


def datetime_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per date column: row count, missing share, first and last instant."""
    columns = list(columns) if columns is not None else columns_of(df, "datetime")
    long = _per_column(
        df,
        columns,
        lambda c: (
            F.count(quoted(c)),
            F.date_format(F.min(quoted(c)), ISO),
            F.date_format(F.max(quoted(c)), ISO),
        ),
        ("valid", "min", "max"),
    )
    return long.select(
        "column",
        F.lit("datetime").alias("type"),
        "count",
        share(F.col("count") - F.col("valid"), F.col("count"), 0.0).alias("missing_share"),
        "min",
        "max",
    )


def boolean_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per boolean column: true share over all rows, missing share."""
    columns = list(columns) if columns is not None else columns_of(df, "bool")
    long = _per_column(
        df,
        columns,
        lambda c: (F.count(quoted(c)), F.count_if(quoted(c))),
        ("valid", "true_rows"),
    )
    return long.select(
        "column",
        F.lit("bool").alias("type"),
        "count",
        share(F.col("true_rows"), F.col("count"), 0.0).alias("true_share"),
        share(F.col("count") - F.col("valid"), F.col("count"), 0.0).alias("missing_share"),
    )


def melt(report: DataFrame, key: str = "column") -> DataFrame:
    """A wide report as ``(column, metric, number, text)``; absent figures are dropped."""
    cells = []
    for f in report.schema:
        if f.name == key:
            continue
        numeric = family(f.dataType) in ("int", "float")
        value = F.col(f.name)
        cells += [
            F.lit(f.name),
            value.cast("double") if numeric else F.lit(None).cast("double"),
            F.lit(None).cast("string") if numeric else value.cast("string"),
        ]
    n = len(cells) // 3
    return report.select(
        key, F.stack(F.lit(n), *cells).alias("metric", "number", "text")
    ).where("number IS NOT NULL OR text IS NOT NULL")


def profile_table(df: DataFrame, params: AuditParams = AuditParams()) -> DataFrame:
    """All columns, each profiled by its family, as long rows.

    The levels of text columns appear as metrics ``top_1``, ``top_2`` ... with
    the level as text and its share as number.
    """
    parts = []
    numeric = columns_of(df, "int", "float")
    if numeric:
        parts.append(melt(numeric_profile(df, numeric, params.quantiles)))
    levels = columns_of(df, "string", "category")
    if levels:
        wide = categorical_profile(df, levels, params.top_k, params.rare_level)
        parts.append(melt(wide.drop("top_levels")))
        parts.append(
            wide.select("column", F.posexplode("top_levels").alias("at", "top")).select(
                "column",
                F.concat(F.lit("top_"), (F.col("at") + 1).cast("string")).alias("metric"),
                F.col("top.share").alias("number"),
                F.col("top.level").alias("text"),
            )
        )
    dates = columns_of(df, "datetime")
    if dates:
        parts.append(melt(datetime_profile(df, dates)))
    flags = columns_of(df, "bool")
    if flags:
        parts.append(melt(boolean_profile(df, flags)))
    return reduce(DataFrame.unionByName, parts)
