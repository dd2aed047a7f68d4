"""Value counts: the shared input of level, distinct, quantile and AUC reports.

One scan turns the wanted columns into (column, value) pairs, and one grouped
count collapses them.  Spark combines on the map side, so a value that fills a
third of the table leaves each task as a single row.

Exact ranks additionally need an order over all values of a column.  A window
without such splitting would sort a whole column in one task, so every value
is first assigned to a *range* of its column.  The range borders are fetched
once as a handful of numbers per column; after that, the range is a pure
function of the value.  A lost executor therefore recomputes the same ranges.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.missing import missing_value, quoted
from ..session import rank_buckets

INF = float("inf")


def with_names(report: DataFrame, names: Sequence[str]) -> DataFrame:
    """Replace the number of a column (``slot``) by its name."""
    known = F.array(*[F.lit(n) for n in names])
    others = [c for c in report.columns if c != "slot"]
    return report.select(F.element_at(known, F.col("slot") + 1).alias("column"), *others)


def level_counts(
    df: DataFrame, columns: Sequence[str], tallies: Mapping[str, Column] | None = None
) -> DataFrame:
    """``(column, level, n, *tallies)`` for the given columns, read as text.

    ``tallies`` are 0/1 row expressions that are summed per level.  Null is a
    level.  Rows are grouped by the number of the column, which is a cheaper
    key than its name.
    """
    tallies = dict(tallies or {})
    return with_names(_counted(cells(df, columns, tallies), ("slot", "level"), tallies), columns)


def cells(
    df: DataFrame, columns: Sequence[str], tallies: Mapping[str, Column] | None = None
) -> DataFrame:
    """``(slot, level, *tallies)``: a row per cell of the columns, read as text."""
    pairs = [x for i, c in enumerate(columns) for x in (F.lit(i), quoted(c).cast("string"))]
    return df.select(
        F.stack(F.lit(len(columns)), *pairs).alias("slot", "level"),
        *[expr.cast("bigint").alias(name) for name, expr in (tallies or {}).items()],
    )


def _counted(long: DataFrame, keys: Sequence[str], tallies: Mapping[str, Column]) -> DataFrame:
    return long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(name).alias(name) for name in tallies]
    )


def bucket_sums(
    long: DataFrame, width: int, tallies: Mapping[str, Column] | None = None
) -> DataFrame:
    """``(slot, bucket, n, *tallies)`` of cells: sums over all levels whose hash falls into a bucket.

    This is a count-min sketch of one row.  Its size is bounded by the columns
    times ``width``, and no level is more frequent than its bucket, so a level
    in a light bucket is proven light without being counted.
    """
    marked = long.withColumn("bucket", _bucket(width))
    return _counted(marked, ("slot", "bucket"), tallies or {})


def _bucket(width: int) -> Column:
    return F.pmod(F.xxhash64("level"), F.lit(width)).cast("int")


def counts_within(
    long: DataFrame, buckets: DataFrame, width: int, tallies: Mapping[str, Column] | None = None
) -> DataFrame:
    """``(slot, level, n, *tallies)`` of the levels in the given ``(slot, bucket)`` alone.

    Cells elsewhere are dropped before the shuffle.  The buckets are broadcast:
    there are at most ``width`` for each column.
    """
    kept = long.withColumn("bucket", _bucket(width)).join(
        F.broadcast(buckets.select("slot", "bucket")), ["slot", "bucket"]
    )
    return _counted(kept, ("slot", "level"), tallies or {})


@dataclass(frozen=True)
class Numeric:
    """A numeric expression to rank: its name, value and whether it is integral."""

    name: str
    value: Column
    integral: bool

    @classmethod
    def of(cls, df: DataFrame, name: str) -> Numeric:
        dtype = df.schema[name].dataType
        value = F.when(~missing_value(quoted(name), dtype), quoted(name))
        integral = isinstance(dtype, T.IntegralType)
        return cls(name, value.cast("bigint" if integral else "double"), integral)


def border_exprs(items: Sequence[Numeric], buckets: int) -> list[Column]:
    """One sketch per column giving its approximate evenly spaced borders.

    Borders only decide how evenly the work is spread, never a result.
    """
    grid = F.array(*[F.lit((i + 1) / buckets) for i in range(buckets - 1)])
    size = F.lit(min(65535, max(200, 10 * buckets)))
    exprs = []
    for i, item in enumerate(items):
        value = item.value.cast("double")
        borders = F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(value, size), grid)
        exprs.append(F.when(F.count(value) > 0, borders).alias(f"__borders_{i}"))
    return exprs


def fetch_borders(
    df: DataFrame, items: Sequence[Numeric], extra: Sequence[Column] = (), buckets: int | None = None
) -> tuple[Row, list[list[float]]]:
    """Run the one-row aggregate pass: ``extra`` figures plus the range borders.

    The result is bounded by ``len(items) * buckets`` numbers, whatever the
    size of the table.
    """
    buckets = buckets or rank_buckets(df.sparkSession)
    row = df.agg(*extra, *border_exprs(items, buckets)).first()
    borders = [
        sorted({b for b in (row[f"__borders_{i}"] or []) if -INF < b < INF})
        for i in range(len(items))
    ]
    return row, borders


def ranged_counts(
    df: DataFrame,
    items: Sequence[Numeric],
    borders: Sequence[Sequence[float]],
    tallies: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``(slot, range, whole, fraction, n, *tallies)`` over the non-missing numbers.

    ``slot`` is the position of the column in ``items``.  Integers fill
    ``whole`` and other numbers ``fraction``, so that long integers keep their
    exact order.
    """
    tallies = dict(tallies or {})
    ranked = df.select(
        *[item.value.alias(f"__v{i}") for i, item in enumerate(items)],
        *[expr.cast("bigint").alias(f"__{name}") for name, expr in tallies.items()],
    )
    ranked = Bucketizer(
        splitsArray=[[-INF, *(b or [0.0]), INF] for b in borders],
        inputCols=[f"__v{i}" for i in range(len(items))],
        outputCols=[f"__r{i}" for i in range(len(items))],
        handleInvalid="keep",
    ).transform(ranked)
    cells = []
    for i, item in enumerate(items):
        value = F.col(f"__v{i}")
        whole = value if item.integral else F.lit(None).cast("bigint")
        fraction = F.lit(None).cast("double") if item.integral else value
        cells += [F.lit(i), F.col(f"__r{i}").cast("int"), whole, fraction]
    long = ranked.select(
        F.stack(F.lit(len(items)), *cells).alias("slot", "range", "whole", "fraction"),
        *[F.col(f"__{name}") for name in tallies],
    )
    # Naming the keys here keeps this stage identical wherever it is used, so
    # that Spark shuffles it once.
    long = long.where(
        "(whole IS NOT NULL OR fraction IS NOT NULL) AND slot IS NOT NULL AND range IS NOT NULL"
    )
    return long.groupBy("slot", "range", "whole", "fraction").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(f"__{name}").alias(name) for name in tallies],
    )


IN_ORDER = ("whole", "fraction")


def _before(total: str, *partition: str, order: Sequence[str]) -> Column:
    window = W.partitionBy(*partition).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum(total).over(window), F.lit(0))


def _number() -> Column:
    return F.coalesce(F.col("whole").cast("double"), F.col("fraction"))


def weighted_moments(counts: DataFrame) -> DataFrame:
    """``(slot, n_valid, n_unique, min, max, mean, std)`` from value counts.

    The deviations are taken from the mean in a second step over the same
    shuffled counts, which is as stable as the usual two-pass formula.
    """
    value, n = _number(), F.col("n").cast("double")
    first = counts.groupBy("slot").agg(
        F.sum("n").alias("n_valid"),
        F.count(F.lit(1)).alias("n_unique"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        (F.sum(value * n) / F.sum(n)).alias("mean"),
    )
    # One row per column.
    centre = first.select("slot", "mean")
    gap = value - F.col("mean")
    spread = (
        counts.join(F.broadcast(centre), "slot").groupBy("slot").agg(F.sum(gap * gap * n).alias("m2"))
    )
    free = F.nullif(F.col("n_valid") - 1, F.lit(0))
    std = F.coalesce(F.sqrt(F.col("m2") / free), F.lit(0.0))
    return first.join(F.broadcast(spread), "slot").select(
        "slot", "n_valid", "n_unique", "min", "max", "mean", std.alias("std")
    )


def exact_quantiles(counts: DataFrame, quantiles: Sequence[float]) -> DataFrame:
    """``(slot, q, value)``: exact quantiles per column, linearly interpolated."""
    sizes = counts.groupBy("slot", "range").agg(F.sum("n").alias("size"))
    # `sizes` holds at most one row per column and range: these windows are small.
    placed = sizes.select(
        "slot",
        "range",
        "size",
        _before("size", "slot", order=["range"]).alias("start"),
        F.sum("size").over(W.partitionBy("slot")).alias("total"),
    )
    wanted = placed.select(
        "slot",
        "range",
        "size",
        "start",
        F.explode(F.array(*[F.lit(float(q)) for q in quantiles])).alias("q"),
        "total",
    ).withColumn("position", F.col("q") * (F.col("total") - 1))
    wanted = wanted.select(
        "slot",
        "range",
        "size",
        "start",
        "q",
        (F.col("position") - F.floor("position")).alias("weight"),
        F.explode(
            F.array(
                F.struct(F.lit("low").alias("side"), F.floor("position").alias("rank")),
                F.struct(F.lit("high").alias("side"), F.ceil("position").alias("rank")),
            )
        ).alias("t"),
    ).where((F.col("t.rank") >= F.col("start")) & (F.col("t.rank") < F.col("start") + F.col("size")))
    # At most two targets per column and quantile: safe to send everywhere.
    targets = wanted.groupBy("slot", "range").agg(
        F.collect_list(
            F.struct("q", "weight", "t.side", (F.col("t.rank") - F.col("start")).alias("rank"))
        ).alias("targets")
    )
    running = counts.join(F.broadcast(targets), ["slot", "range"]).withColumn(
        "seen", _before("n", "slot", "range", order=IN_ORDER)
    )
    hits = running.select(
        "slot",
        _number().alias("value"),
        F.explode(
            F.filter(
                "targets",
                lambda t: (t["rank"] >= F.col("seen")) & (t["rank"] < F.col("seen") + F.col("n")),
            )
        ).alias("t"),
    )
    values = hits.groupBy("slot", F.col("t.q").alias("q")).agg(
        F.max(F.when(F.col("t.side") == "low", F.col("value"))).alias("low"),
        F.max(F.when(F.col("t.side") == "high", F.col("value"))).alias("high"),
        F.max("t.weight").alias("weight"),
    )
    between = F.col("low") + (F.col("high") - F.col("low")) * F.col("weight")
    same = F.col("low") == F.col("high")
    return values.select(
        "slot", "q", F.when(same, F.col("low")).otherwise(between).alias("value")
    )


def area_under_curve(counts: DataFrame, pos: str = "n_pos", neg: str = "n_neg") -> DataFrame:
    """ROC-AUC of each column on average ranks, ties counted half.

    Needs ``ranged_counts`` with two tallies.  A column that lacks one of the
    classes gets null.
    """
    # Within a range: pairs of a positive and a smaller negative, ties half.
    running = counts.withColumn("below", _before(neg, "slot", "range", order=IN_ORDER))
    per_range = running.groupBy("slot", "range").agg(
        F.sum(
            F.col(pos).cast("double") * (F.col("below") + F.col(neg) / 2.0)
        ).alias("wins"),
        F.sum(pos).alias("pos"),
        F.sum(neg).alias("neg"),
        F.count(F.lit(1)).alias("distinct_values"),
    )
    # Across ranges: one row per column and range from here on.
    shifted = per_range.withColumn("lower", _before("neg", "slot", order=["range"]))
    sums = shifted.groupBy("slot").agg(
        F.sum(F.col("wins") + F.col("pos").cast("double") * F.col("lower")).alias("wins"),
        F.sum("pos").alias("n_pos"),
        F.sum("neg").alias("n_neg"),
        F.sum("distinct_values").alias("n_unique"),
    )
    pairs = F.nullif(F.col("n_pos").cast("double") * F.col("n_neg"), F.lit(0.0))
    return sums.select("slot", (F.col("wins") / pairs).alias("auc"), "n_pos", "n_neg", "n_unique")
