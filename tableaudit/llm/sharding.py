"""Sharding by extendible hashing.

A shard is a prefix of the row hash.  The directory starts with one shard; a
shard over its byte limit is split on the next bit, and only such a shard, until
all fit.  Splitting works on sums by prefix: a round sums bytes some bits deeper
under the shards that are still too large, and reads off where each branch first
fits.  Rows are looked up by the prefix at a round's depth, an equality join
against the directory.

Rows with the same hash (copies of one row) share all 60 bits.  Where such rows
alone are more than a shard holds, they are written out once with a second hash,
over their place, and split on its bits; so even a row repeated over a third of
the table is spread, and every later look sees the same places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableaudit.llm.common import staged

LIMIT_BYTES = 1 << 20
BITS = 60
ROUND_BITS = 8


def _md5_bits(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _cell(depth: int) -> Column:
    """The first ``depth`` of the 60 bits, as a number."""
    return F.shiftright("bits", BITS - depth)


def _name(bits: Column, depth: Column | int) -> Column:
    """The first ``depth`` bits as text of 0 and 1."""
    return F.substring(F.lpad(F.bin(bits), BITS, "0"), F.lit(1), F.lit(depth) if isinstance(depth, int) else depth)


def row_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text.cast("string")).cast("long"), F.lit(0).cast("long"))


def shards(
    docs: DataFrame,
    limit_bytes: int = LIMIT_BYTES,
    size: Callable[[Column], Column] = row_bytes,
    round_bits: int = ROUND_BITS,
) -> DataFrame:
    """``row`` (a struct of all columns of ``docs``), its ``bytes`` and its ``shard``, a bit prefix as text.

    Each shard's bytes are within ``limit_bytes``, except where one row alone is
    larger: it gets a shard of its own.  Ids and texts may be null (hashed as
    empty, zero bytes); rows repeated exactly may go to any shard of their branch;
    an empty table gives no rows.  The root shard, when all fits, is ''.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        size(F.col("text")).alias("bytes"),
        F.lit(0).cast("long").alias("base"),
        _md5_bits(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text"))).alias("bits"),
    )
    rounds, heavy = directory(rows.select("base", "bits", "bytes"), limit_bytes, round_bits)
    facts = ["row", "bytes"]
    if heavy.isEmpty():
        return _looked_up(rows, rounds, False).select(*facts, _name(F.col("bits"), F.col("depth")).alias("shard"))
    # Copies that are too many for one shard; each such hash holds more than a shard's bytes.
    heavy = heavy.select(F.col("cell").alias("heavy"))
    rest = rows.join(heavy, F.col("bits") == F.col("heavy"), "left_anti")
    copies = rows.join(heavy, F.col("bits") == F.col("heavy"), "left_semi")
    copies = staged(
        copies.select("row", "bytes", F.col("bits").alias("base"), _md5_bits(F.monotonically_increasing_id().cast("string")).alias("bits")),
        "copies",
    )
    below, _ = directory(copies.select("base", "bits", "bytes"), limit_bytes, round_bits, last=True)
    return _looked_up(rest, rounds, False).select(*facts, _name(F.col("bits"), F.col("depth")).alias("shard")).unionAll(
        _looked_up(copies, below, True).select(
            *facts, F.concat(_name(F.col("base"), BITS), _name(F.col("bits"), F.col("depth"))).alias("shard")
        )
    )


def _looked_up(rows: DataFrame, rounds: list[tuple[int, DataFrame]], many: bool) -> DataFrame:
    """The rows with the depth of their shard; without ``many`` bases the cell alone is the key."""
    depth = F.lit(None).cast("int")
    for number, (below, found) in enumerate(rounds):
        names = ["base", "cell", "depth"] if many else ["cell", "depth"]
        cells = found.select(*[F.col(c).alias(f"{c}{number}") for c in names])
        at = _cell(below) == F.col(f"cell{number}")
        if many:
            at = at & (F.col("base") == F.col(f"base{number}"))
        rows = rows.join(cells, at, "left")
        depth = F.coalesce(depth, F.col(f"depth{number}"))
    return rows.withColumn("depth", depth)


def directory(
    sizes: DataFrame, limit_bytes: int, round_bits: int = ROUND_BITS, last: bool = False
) -> tuple[list[tuple[int, DataFrame]], DataFrame]:
    """For each round its depth and the directory (base, cell, depth): the shard's depth of the rows with that prefix.

    ``sizes`` has (base, bits, bytes); every base is a tree of its own.  The first
    round goes four bits deeper than equal shards would need, the others
    ``round_bits`` deeper than the last.  The second result holds the cells that are
    too large with all bits; with ``last`` they are shards all the same.
    """
    if limit_bytes < 1:
        raise ValueError("limit_bytes must be positive")
    total = sizes.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    depth = 0
    below = max(0, (-(-total // limit_bytes) - 1).bit_length()) + 4
    rounds: list[tuple[int, DataFrame]] = []
    open_cells = None
    while True:
        below = min(below, BITS)
        cells = sizes.select("base", "bytes", _cell(below).alias("cell"), _cell(depth).alias("top"))
        if open_cells is not None:
            cells = cells.join(open_cells, ["base", "top"], "left_semi")
        cells = staged(
            cells.groupBy("base", "cell").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n")), "cells"
        )
        # Every cell counts for each of its prefixes from the open depth on.
        each = cells.select("base", "cell", "bytes", "n", F.explode(F.sequence(F.lit(depth), F.lit(below))).alias("depth"))
        each = each.withColumn("prefix", F.expr(f"shiftright(cell, {below} - depth)"))
        nodes = each.groupBy("base", "depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
        fits = (F.col("bytes") <= limit_bytes) | (F.col("n") == 1)
        if last:
            fits = fits | (F.col("depth") == BITS)
        fitting = nodes.where(fits).select("base", "depth", "prefix")
        # A cell's shard is its shortest prefix that fits: those above it are too large.
        found = staged(
            each.join(fitting, ["base", "depth", "prefix"]).groupBy("base", "cell").agg(F.min("depth").alias("depth")),
            "directory",
        )
        rounds.append((below, found))
        open_cells = staged(
            cells.join(found, ["base", "cell"], "left_anti").select("base", F.col("cell").alias("top")), "open-cells"
        )
        if below == BITS or open_cells.isEmpty():
            return rounds, open_cells.select("base", F.col("top").alias("cell"))
        depth, below = below, below + round_bits


def shard_sizes(sharded: DataFrame) -> DataFrame:
    return sharded.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("bytes").alias("shard_bytes")
    )
