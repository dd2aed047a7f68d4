"""Cell values looked up in maps of any size.

A small map is part of the expression.  A larger one is a table that is joined:
broadcast while its measured size allows it, else shuffled.  For the shuffle the
frequent cells are told apart first, by bucket sums; there are few of them, so
their part of the map is broadcast and no task gets all rows of one value.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staged
from .counts import bucket_sums, counts_within

# Up to so many entries a map is a literal; up to so many bytes of text it is broadcast.
MOST_LITERAL = 1000
MOST_BROADCAST_BYTES = 64 << 20
# A cell is frequent when it owns more than one in HOT_PARTS of the rows.
HOT_PARTS, BUCKETS = 1000, 1 << 16


def is_large(mapping: Mapping | DataFrame | None) -> bool:
    return isinstance(mapping, DataFrame) or (mapping is not None and len(mapping) > MOST_LITERAL)


def map_table(spark: SparkSession, mapping: Mapping | DataFrame, kind: str) -> DataFrame:
    """``(key, value)``; a DataFrame gives its first two columns, rows without a key are left out."""
    if isinstance(mapping, DataFrame):
        key, value = mapping.columns[:2]
        pairs = mapping.select(F.col(f"`{key}`").alias("key"), F.col(f"`{value}`").alias("value"))
    else:
        pairs = spark.createDataFrame(list(mapping.items()), f"key string, value {kind}")
    return pairs.select(F.col("key").cast("string"), F.col("value").cast(kind)).where("key IS NOT NULL")


def require_unique(pairs: DataFrame) -> DataFrame:
    """The map with each entry once; a key with two values is an error."""
    single = pairs.distinct()
    twice = single.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy("key").limit(5).collect()
    if twice:
        raise ValueError(f"keys with more than one value: {[r['key'] for r in twice]}")
    return single


def _frequent(df: DataFrame) -> DataFrame:
    """``(level)`` of the frequent keys of ``df`` (a column ``key``): fewer than ``HOT_PARTS``."""
    long = df.select(F.lit(0).alias("slot"), F.col("key").alias("level")).where("level IS NOT NULL")
    rows = df.count()
    sums = bucket_sums(long, BUCKETS).where(F.col("n") * HOT_PARTS > rows)
    return counts_within(long, sums, BUCKETS).where(F.col("n") * HOT_PARTS > rows).select("level")


def look_up(
    df: DataFrame,
    key: Column,
    mapping: Mapping | DataFrame,
    column: str,
    kind: str = "string",
) -> DataFrame:
    """``df`` with ``column``, the value of each key; null where there is no key or no entry."""
    pairs = staged(require_unique(map_table(df.sparkSession, mapping, kind)), "map")
    pairs = pairs.select(F.col("key").alias("__key"), F.col("value").alias("__value"))
    size = pairs.agg(F.sum(F.octet_length("__key") + F.coalesce(F.octet_length(F.col("__value").cast("string")), F.lit(0)))).first()[0]
    marked = df.withColumn("__cell", key)
    names = [F.col(f"`{c}`") for c in df.columns]
    if (size or 0) <= MOST_BROADCAST_BYTES:
        found = marked.join(F.broadcast(pairs), F.col("__cell") == F.col("__key"), "left")
        return found.select(*names, F.col("__value").alias(column))
    frequent = staged(_frequent(marked.select(F.col("__cell").alias("key"))), "frequent-cells")
    hot = frequent.join(pairs, F.col("level") == F.col("__key"), "left").select("level", F.col("__value").alias("__hot"))
    split = marked.join(F.broadcast(hot), F.col("__cell") == F.col("level"), "left")
    near = split.where("level IS NOT NULL OR __cell IS NULL").select(*names, F.col("__hot").alias(column))
    far = split.where("level IS NULL AND __cell IS NOT NULL").join(pairs, F.col("__cell") == F.col("__key"), "left")
    return near.unionAll(far.select(*names, F.col("__value").alias(column)))
