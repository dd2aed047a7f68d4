"""Which rows differ between two versions of a table.

Rows are compared by digest.  Signed sums over prefixes of the digest, plus for
one side and minus for the other, are zero where both sides hold the same rows as
often.  The comparison descends only into prefixes that are not, a few bits at a
time; equal versions cost one look and read no rows back.  In the open prefixes
digests are counted one by one, and only rows whose counts differ are fetched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.missing import quoted
from ..session import small_frame, staged
from .dedup import text_digest

BITS, LEVELS = 12, 2
SIDES = ("left", "right")
# Up to so many digests or prefixes (about 50 bytes each) are broadcast.
MOST_BROADCAST = 1_000_000
_HASH_BITS = 60


def _number(start: int, digits: int) -> Column:
    return F.conv(F.substring("digest", start, digits), 16, 10).cast("bigint")


def _digests(left: DataFrame, right: DataFrame) -> DataFrame:
    """``(sign, digest)`` of all rows, plus one for the left and minus one for the right.

    They are read several times, and are written once: a row's digest may cost a join and casts.
    """
    both = left.select(F.lit(1).cast("bigint").alias("sign"), F.unhex(text_digest(left)).alias("digest")).unionAll(
        right.select(F.lit(-1).cast("bigint").alias("sign"), F.unhex(text_digest(right)).alias("digest"))
    )
    return staged(both, "digests").select("sign", F.lower(F.hex("digest")).alias("digest"))


def _prefix(bits: int) -> Column:
    return F.shiftright(_number(1, _HASH_BITS // 4), _HASH_BITS - bits)


def _small(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= MOST_BROADCAST else df


def stage_differences(
    left: DataFrame,
    right: DataFrame,
    columns: Sequence[str] | None = None,
    bits: int = BITS,
    levels: int = LEVELS,
) -> DataFrame:
    """``(side, *columns, copies)``: rows that one side holds more often, and by how many copies.

    The left rows are those of ``left EXCEPT ALL right``, the right ones those of
    the reverse.  Null equals null, and the order of columns does not matter;
    values are compared as text, so a change of a column's type alone is none.
    ``columns`` are those to show, by default all.
    """
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError("both sides need the same columns")
    if not 1 <= bits * levels <= _HASH_BITS:
        raise ValueError(f"prefixes need 1 to {_HASH_BITS} bits")
    right = right.select(*[quoted(c) for c in left.columns])
    shown = list(columns) if columns is not None else left.columns
    digests = _digests(left, right)
    signed = lambda value: F.sum(F.col("sign") * value)
    open_prefixes, n_open, depth = None, 0, 0
    for level in range(1, levels + 1):
        rows = digests
        if open_prefixes is not None:
            rows = rows.withColumn("prefix", _prefix(depth)).join(_small(open_prefixes, n_open), "prefix", "left_semi")
        # Sums of 32-bit pieces hold for two billion rows of a prefix.
        sums = rows.groupBy(_prefix(bits * level).alias("prefix")).agg(
            F.sum("sign").alias("n"), signed(_number(17, 8)).alias("a"), signed(_number(25, 8)).alias("b")
        )
        depth = bits * level
        open_prefixes = staged(sums.where("n != 0 OR a != 0 OR b != 0").select("prefix"), "open-prefixes")
        n_open = open_prefixes.count()
        if not n_open:
            fields = [T.StructField("side", T.StringType()), *[left.schema[c] for c in shown]]
            return small_frame(left.sparkSession, [], T.StructType([*fields, T.StructField("copies", T.LongType())]))
        if n_open > 1 << (depth - 1) or n_open > MOST_BROADCAST:
            break
    inside = digests.withColumn("prefix", _prefix(depth)).join(_small(open_prefixes, n_open), "prefix", "left_semi")
    surplus = staged(inside.groupBy("digest").agg(F.sum("sign").alias("n")).where("n != 0"), "surplus")
    n_surplus = surplus.count()
    parts = []
    for side, df, sign in ((SIDES[0], left, 1), (SIDES[1], right, -1)):
        wanted = surplus.where(F.col("n") * sign > 0).select("digest", (F.col("n") * sign).alias("copies"))
        marked = df.select(text_digest(df).alias("digest"), *[quoted(c).alias(f"c{i}") for i, c in enumerate(shown)])
        found = marked.join(_small(wanted, n_surplus), "digest").dropDuplicates(["digest"])
        cells = [F.col(f"c{i}").alias(c) for i, c in enumerate(shown)]
        parts.append(found.select(F.lit(side).alias("side"), *cells, "copies"))
    return parts[0].unionAll(parts[1])


def difference_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """``(side, rows, copies)`` of both sides: how many distinct rows, and copies, are in excess."""
    found = stage_differences(left, right, [])
    sides = small_frame(left.sparkSession, [(s,) for s in SIDES], "side string")
    counted = found.groupBy("side").agg(F.count(F.lit(1)).alias("rows"), F.sum("copies").alias("copies"))
    zero = F.lit(0).cast("bigint")
    # One row per side.
    return sides.join(F.broadcast(counted), "side", "left").select(
        "side", F.coalesce("rows", zero).alias("rows"), F.coalesce("copies", zero).alias("copies")
    )
