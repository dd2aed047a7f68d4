"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Targets.  Sources in code-point order (null last) weigh by a repeating list;
   targets share all words, and stop at a multiple of their source's size, the
   excess being shared again by weight (water filling, in closed form).
2. Blocks.  The documents of a source are permuted by a hash of (seed, doc_id)
   and cut at hash ranges into blocks of about ``block_words`` words.  A source
   gives its blocks in that order, as often as its target asks; the last block
   is cut at the document nearest to the target.
3. Tree.  The exact numbers of blocks by source are the colours of an urn.  Each
   node halves its output shards and draws, source after source, how many of its
   blocks go to the left half: a multivariate hypergeometric draw, by inversion.
   A source's share of a shard is then a run of its permuted blocks, so draws are
   disjoint without any ranking of blocks across sources.
4. Inside a shard, rows are ordered by another hash.

Only (source, block) sums and one row per source and tree node are ranked; no
window spans a source's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tableaudit.llm.common import TOKEN, staged

WEIGHTS = (5.0, 2.0, 1.0)
MOST_COPIES = 3
BLOCK_WORDS = 100_000
SEED = "mix-1"
# Sources up to this number, with about 100 bytes each, are broadcast.
MOST_BROADCAST = 20_000
REPEATS = 64
# Blocks that an output shard holds, unless a number of shards is given.
SHARD_BLOCKS = 16


def _hash(*parts: Column) -> Column:
    """60 bits of MD5, as a number: the same in every SQL engine."""
    text = F.concat_ws("|", *parts)
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _hash_range() -> int:
    return 1 << 60


def text_size(text: Column) -> Column:
    """Number of whitespace-separated words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)).cast("long"), F.lit(0).cast("long"))


def source_targets(
    sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST_COPIES
) -> DataFrame:
    """One row per source of ``sized`` (source, never null; size): source_size, target.

    A source without words has target 0.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy("source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("place", F.row_number().over(order) - 1).withColumn("weight", weight)
    live = F.col("source_size") > 0
    # Sources reach their limit in the order of limit / weight.
    up = Window.orderBy(F.col("limit_ratio"), F.col("place"))
    whole = Window.partitionBy()
    filled = (
        ranked.withColumn("limit_ratio", F.when(live, most * F.col("source_size") / F.col("weight")))
        .where(live)
        .withColumn("full", F.sum(most * F.col("source_size")).over(up.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("full", F.coalesce("full", F.lit(0.0)))
        .withColumn("open_weight", F.sum("weight").over(up.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("total", F.sum("source_size").over(whole))
        .withColumn("level", (F.col("total") - F.col("full")) / F.col("open_weight"))
        # The first source, in that order, that its level does not fill sets the level for all.
        .withColumn(
            "first",
            F.min(F.when(F.col("level") <= F.col("limit_ratio"), F.struct("limit_ratio", "place", "level"))).over(whole),
        )
        .withColumn("level", F.col("first.level"))
        .withColumn("target", F.least(F.col("weight") * F.col("level"), most * F.col("source_size")))
        .select("place", "target")
    )
    return ranked.join(filled, "place", "left").select(
        "source", "source_size", F.coalesce("target", F.lit(0.0)).alias("target")
    )


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value written, and computed, a single time, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _log_factorial(n: Column) -> Column:
    """ln n! by Stirling's series, shifted by 8 to be exact to 1e-12 for all n >= 0."""

    def series(z: Column) -> Column:
        shift = F.ln((z - 1) * (z - 2) * (z - 3) * (z - 4)) + F.ln((z - 5) * (z - 6) * (z - 7) * (z - 8))
        tail = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
        return (z - 0.5) * F.ln(z) - z + 0.9189385332046727 + tail - shift

    return _once(n.cast("double") + 9.0, series)


def _draw(uniform: Column, colour: Column, others: Column, drawn: Column) -> Column:
    """How many of ``colour`` balls are among ``drawn`` of ``colour + others``: hypergeometric, by inversion.

    Probabilities are summed over twelve standard deviations around the mean, each
    from the one before; what lies outside is below 1e-30.
    """
    share = colour / F.greatest(colour + others, F.lit(1))
    mean, spread = drawn * share, 12 * F.sqrt(drawn * share * (1 - share)) + 12
    low = F.greatest(F.lit(0).cast("long"), drawn - others)
    ends = F.struct(
        F.greatest(low, F.floor(mean - spread).cast("long")).alias("first"),
        F.least(F.least(colour, drawn), F.ceil(mean + spread).cast("long")).alias("last"),
        uniform.alias("uniform"),
    )

    def log_p(k: Column) -> Column:
        parts = F.array(
            colour, others, drawn, colour + others - drawn,
            k, colour - k, drawn - k, others - drawn + k, colour + others,
        )
        # Four factorials above the line, five below.
        logs = F.transform(parts, lambda n, i: F.when(i < 4, _log_factorial(n)).otherwise(-_log_factorial(n)))
        return F.aggregate(logs, F.lit(0.0), lambda s, x: s + x)

    def invert(e: Column) -> Column:
        # The chance of k + 1 over that of k.
        ratio = lambda k: (colour - k) * (drawn - k) / ((k + 1) * (others - drawn + k + 1))
        start = F.struct(F.lit(0.0).alias("sum"), F.exp(log_p(e["first"])).alias("p"), e["first"].alias("k"))
        step = F.aggregate(
            F.sequence(e["first"], e["last"]),
            start,
            lambda s, k: F.when(
                s["sum"] <= e["uniform"],
                F.struct((s["sum"] + s["p"]).alias("sum"), (s["p"] * ratio(k)).alias("p"), k.alias("k")),
            ).otherwise(s),
        )
        return F.when(e["last"] > e["first"], step["k"]).otherwise(e["first"])

    return _once(ends, invert)


def _uniform(*parts: Column) -> Column:
    return (_hash(*parts).cast("double") + 0.5) / float(_hash_range())


def split_quotas(quotas: DataFrame, shards: int, seed: str = SEED) -> DataFrame:
    """Deal each source's blocks to shards: (source, shard, first, last), runs of its block numbers.

    ``quotas`` has (source, quota).  Shards get equal numbers of blocks, up to one.
    """
    item = T.StructType([T.StructField("source", T.StringType()), T.StructField("quota", T.LongType())])
    urn = F.sort_array(F.collect_list(F.struct("source", F.col("quota").cast("long").alias("quota"))))
    nodes = quotas.groupBy().agg(urn.alias("urn")).select(
        F.lit(0).cast("long").alias("shard"), F.lit(shards).cast("long").alias("width"), "urn"
    )
    total = lambda urn: F.aggregate(urn, F.lit(0).cast("long"), lambda s, x: s + x["quota"])
    depth = max(0, (shards - 1).bit_length())
    for level in range(depth):
        half = F.floor((F.col("width") + 1) / 2).cast("long")
        # All balls up to a shard's end, so that sizes differ by one block at most.
        wanted = F.floor(total(F.col("urn")) * half / F.greatest(F.col("width"), F.lit(1))).cast("long")
        empty = F.array().cast(T.ArrayType(item))

        def deal(state: Column, x: Column) -> Column:
            colour, others = x["quota"], state["rest"] - x["quota"]
            u = _uniform(F.lit(seed), F.lit(str(level)), state["shard"].cast("string"), x["source"])
            part = lambda n: F.array(F.struct(x["source"].alias("source"), n.alias("quota")))
            return _once(
                _draw(u, colour, others, state["wanted"]),
                lambda left: F.struct(
                    others.alias("rest"),
                    (state["wanted"] - left).alias("wanted"),
                    state["shard"].alias("shard"),
                    F.concat(state["left"], part(left)).alias("left"),
                    F.concat(state["right"], part(colour - left)).alias("right"),
                ),
            )

        dealt = F.aggregate(
            "urn",
            F.struct(
                total(F.col("urn")).alias("rest"), wanted.alias("wanted"), F.col("shard").alias("shard"),
                empty.alias("left"), empty.alias("right"),
            ),
            deal,
        )
        split = nodes.select("shard", "width", "urn", half.alias("half"), dealt.alias("dealt"))
        children = F.array(
            F.struct(F.col("shard"), F.col("half").alias("width"), F.col("dealt.left").alias("urn")),
            F.struct(
                (F.col("shard") + F.col("half")).alias("shard"), (F.col("width") - F.col("half")).alias("width"),
                F.col("dealt.right").alias("urn"),
            ),
        )
        # Written level by level: a few rows each, and the plan stays as small as one level.
        nodes = staged(split.select(F.explode(children).alias("child")).select("child.*").where("width > 0"), "tree")
    leaves = nodes.select("shard", F.explode("urn").alias("x")).select("shard", "x.source", "x.quota")
    run = Window.partitionBy("source").orderBy("shard")
    return leaves.withColumn("last", F.sum("quota").over(run)).select(
        "source", "shard", (F.col("last") - F.col("quota")).alias("first"), "last"
    )


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows with their source's figures; a source that owns a third of them is no task of its own.

    Few sources are broadcast: their number is counted first.  Beyond that each
    source's figures are repeated, and its rows dealt by hash among the repeats.
    """
    plan = staged(plan, "source-plan")
    if plan.count() <= MOST_BROADCAST:
        return rows.join(F.broadcast(plan), "source")
    repeats = F.explode(F.sequence(F.lit(0), F.lit(REPEATS - 1)))
    return rows.withColumn("repeat", F.pmod(F.col("h"), F.lit(REPEATS)).cast("int")).join(
        plan.withColumn("repeat", repeats), ["source", "repeat"]
    ).drop("repeat")


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    most: float = MOST_COPIES,
    block_words: int = BLOCK_WORDS,
    shards: int | None = None,
    seed: str = SEED,
    size: Callable[[Column], Column] = text_size,
    place: bool = True,
) -> DataFrame:
    """How often each row of ``docs`` (doc_id, text, source, ...) is taken, and where its copies go.

    Returns ``row`` (a struct of all columns, whatever their names), size,
    source_size, target, copies and, with ``place``, ``shards``, an array of one
    (shard, position) per copy.  Rows without words are never taken; a null
    source is a source like any other and a null id is hashed as an empty one.
    Without ``shards`` their number follows the blocks of the mix.
    Equal rows may stand anywhere in the order of their block.  An empty table
    gives an empty result.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        # Never null, in code-point order with null last: joins and windows share one partitioning.
        F.coalesce(F.concat(F.lit("0"), F.col("source")), F.lit("1")).alias("source"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"),
        size(F.col("text")).alias("size"),
    ).withColumn("h", _hash(F.lit(seed), F.col("key")))
    plan = source_targets(rows.select("source", "size"), weights, most)
    plan = plan.withColumns(
        {
            "n_blocks": F.greatest(F.ceil(F.col("source_size") / block_words), F.lit(1)).cast("long"),
            "whole": F.floor(
                F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
            ).cast("long"),
        }
    ).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    # Equal ranges of the hash, by its leading 30 bits, so that the product stays exact.
    number = F.floor(F.shiftright(F.col("h"), 30) * F.col("n_blocks") / float(1 << 30)).cast("long")
    dealt = _with_plan(rows, plan).withColumn("block", number)
    blocks = dealt.groupBy("source", "block").agg(
        F.sum("size").alias("block_size"), F.first("rest").alias("rest"), F.first("whole").alias("whole")
    )
    order = Window.partitionBy("source").orderBy("block")
    before = F.sum("block_size").over(order.rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.withColumn("before", F.coalesce(before, F.lit(0).cast("long"))).withColumn(
        "rank", F.row_number().over(order).cast("long") - 1
    )
    # A source's units are its blocks in order, pass after pass.
    quotas = blocks.groupBy("source").agg(
        (F.first("whole") * F.count(F.lit(1)) + F.count(F.when(F.col("before") < F.col("rest"), 1))).alias("quota"),
        F.count(F.lit(1)).alias("n"),
    )
    extra = blocks.select("source", "block", "before", "rank")
    if place:
        quotas = staged(quotas, "quotas")
        if shards is None:
            units = quotas.agg(F.sum("quota")).first()[0] or 0
            shards = max(1, -(-units // SHARD_BLOCKS))
        cuts = (
            split_quotas(quotas.select("source", "quota"), shards, seed)
            .where("last > first")
            .groupBy("source")
            .agg(F.sort_array(F.collect_list(F.struct("last", "shard"))).alias("cuts"))
        )
        extra = extra.join(quotas.select("source", "n").join(cuts, "source", "left"), "source")
    # Documents of the block in which the rest of the target ends are taken while that brings the sum nearer.
    within = Window.partitionBy("source", "block").orderBy("h", "key", "size")
    run = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1))
    start = F.col("before") + F.coalesce(run, F.lit(0).cast("long"))
    taken = (F.col("rest") > 0) & (start + F.col("size") / 2.0 <= F.col("rest"))
    mixed = dealt.join(extra, ["source", "block"]).withColumn(
        "copies", F.when(F.col("size") > 0, F.col("whole") + taken.cast("long")).otherwise(F.lit(0).cast("long"))
    )
    facts = ["row", "size", "source_size", "target", "copies"]
    if not place:
        return mixed.select(*facts)
    copies = F.when(F.col("copies") > 0, F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).otherwise(
        F.array().cast("array<long>")
    )
    placed = F.transform(
        copies,
        lambda c: F.struct(
            F.filter("cuts", lambda x: x["last"] > c * F.col("n") + F.col("rank"))[0]["shard"].alias("shard"),
            _hash(F.lit(seed + "/order"), F.col("key"), c.cast("string")).alias("position"),
        ),
    )
    return mixed.select(*facts, placed.alias("shards"))


def mixed_rows(mixed: DataFrame) -> DataFrame:
    """The mix itself: ``row`` once per copy, with its ``shard`` and ``position``, shard by shard in the shuffled order.

    Tasks are ranges of (shard, position), so a large shard is not one task.
    """
    each = mixed.select("row", F.explode("shards").alias("at")).select("row", "at.shard", "at.position")
    return each.repartitionByRange("shard", "position").sortWithinPartitions("shard", "position")


def mix_digest(docs: DataFrame) -> DataFrame:
    """How many words of each document the mix takes, by the copies placed in its shards.

    Texts are measured first, so they are not moved.
    """
    sized = docs.select("doc_id", "source", text_size(F.col("text")).alias("text"))
    placed = F.size(F.filter("shards", lambda at: at["shard"].isNotNull() & at["position"].isNotNull()))
    return mix(sized, size=lambda n: n).select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", F.round("target", 6).alias("target"),
        (F.col("size") * placed).alias("taken"),
    )
