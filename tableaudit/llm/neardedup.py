"""Near duplicates by MinHash with tensored banding.

A document's signature has two small collections of ``tables`` keys, each key made
of ``rows`` minhash values.  A table's key is a pair, one key from each
collection, so tables * tables tables need only 2 * tables * rows minhashes.  Two
texts meet in some table exactly when they share a key in both collections; with
12 keys of 3 values, texts at the threshold of 0.85 miss each other with
probability 2e-5, and texts that share a tenth of their shingles meet with 1e-4.

Only texts that share a key of the first collection are expanded into pairs of
keys.  Each table entry links its members to its smallest one, and the connected
components of these candidate links are blocks.  All links are then confirmed on
full shingle sets, block by block: a search in breadth, which compares a text with
all texts of its block not reached yet, finds the components without listing
pairs.  A block over ``task_shingles`` is cut into parts, and every pair of parts
is searched in a task of its own, so no task holds more than two parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableaudit.llm.common import folded, staged
from tableaudit.llm.components import connected

SHINGLE = 5
PERCENT = 85
TABLES, ROWS = 12, 3
TASK_SHINGLES = 4_000_000
_CHUNK = 1 << 15


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False) if words else np.zeros(0, np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def shingle_set(words: list[bytes], n: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word n-grams; fewer words are one shingle."""
    if not words:
        return np.zeros(0, np.uint64)
    h = _word_hashes(words)
    n = min(n, len(words))
    g = h[: len(h) - n + 1].copy()
    for k in range(1, n):
        g = _mix(g) + h[k : len(h) - n + 1 + k]
    return np.unique(_mix(g + np.uint64(n)))


def _functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Parameters of the hash functions, the same in every task."""
    random = np.random.Generator(np.random.PCG64(20240501))
    draw = lambda: random.integers(0, 1 << 63, count, dtype=np.uint64)
    return (draw() << np.uint64(1)) | np.uint64(1), draw()


def minhashes(sets: list[np.ndarray], count: int) -> np.ndarray:
    """``count`` minhash values of each set, none of which is empty."""
    factors, masks = _functions(count)
    out = np.empty((len(sets), count), np.uint64)
    at = 0
    while at < len(sets):
        end, held = at, 0
        while end < len(sets) and (end == at or held + len(sets[end]) <= _CHUNK):
            held += len(sets[end])
            end += 1
        flat = np.concatenate(sets[at:end])
        starts = np.cumsum([0] + [len(s) for s in sets[at : end - 1]])
        for j in range(count):
            out[at:end, j] = np.minimum.reduceat((flat ^ masks[j]) * factors[j], starts)
        at = end
    return out


SIGNED = "doc_id long, raw_key long, n_shingles long, text_key binary, first array<long>, second array<long>"
_LONGS = pa.list_(pa.int64())
_SIGNED = pa.schema(
    [
        ("doc_id", pa.int64()), ("raw_key", pa.int64()), ("n_shingles", pa.int64()), ("text_key", pa.binary()),
        ("first", _LONGS), ("second", _LONGS),
    ]
)


def _signed(batches: Iterator[pa.RecordBatch], shingle: int, tables: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            words = [t.split() for t in folded(part.column(2))]
            sets = [shingle_set(w, shingle) for w in words]
            full = [i for i, s in enumerate(sets) if len(s)]
            keys = np.zeros((len(sets), 2 * tables), np.int64)
            if full:
                values = minhashes([sets[i] for i in full], 2 * tables * rows).reshape(len(full), 2 * tables, rows)
                key = np.broadcast_to(np.arange(2 * tables, dtype=np.uint64), values.shape[:2]).copy()
                for r in range(rows):
                    key = _mix(key) + values[:, :, r]
                keys[full] = _mix(key).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(1),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(b" ".join(w), digest_size=16).digest() for w in words], pa.binary()),
                    pa.array(list(keys[:, :tables]), _LONGS),
                    pa.array(list(keys[:, tables:]), _LONGS),
                ],
                schema=_SIGNED,
            )


def _components(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set the position of its component's first set; sets are linked at ``percent`` of Jaccard similarity."""
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    sizes = sizes[order]
    flat = np.concatenate([sets[i] for i in order])
    names, flat = np.unique(flat, return_inverse=True)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    marks = np.zeros(len(names), np.int8)
    root = np.full(len(sets), -1)
    # Texts not reached yet: their places in the order, and their shingles one after the other.
    left, left_flat, left_starts = np.arange(len(sets)), flat, starts
    alive = np.ones(len(sets), bool)
    for first in range(len(sets)):
        if root[first] >= 0:
            continue
        root[first], alive[first], todo = first, False, [first]
        while todo:
            p = todo.pop()
            size = sizes[p]
            if alive.sum() * 2 < len(left):
                left = np.flatnonzero(alive)
                if not len(left):
                    break
                left_flat = np.concatenate([flat[starts[i] : ends[i]] for i in left])
                left_starts = np.cumsum(sizes[left]) - sizes[left]
            # Linked sets have sizes within the similarity of each other; places are in order of size.
            low = np.searchsorted(sizes[left], size * percent / 100 - 1e-9)
            high = np.searchsorted(sizes[left], size * 100 / percent + 1e-9, "right")
            if low >= high:
                continue
            begin = left_starts[low]
            end = left_starts[high] if high < len(left) else len(left_flat)
            own = flat[starts[p] : ends[p]]
            marks[own] = 1
            shared = np.add.reduceat(marks[left_flat[begin:end]], left_starts[low:high] - begin, dtype=np.int64)
            marks[own] = 0
            near = left[low:high]
            linked = near[alive[near] & (100 * shared >= percent * (size + sizes[near] - shared))]
            root[linked], alive[linked] = first, False
            todo.extend(linked.tolist())
    out = np.empty(len(sets), np.int64)
    out[order] = order[root]
    return out


FOUND = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _searched(batches: Iterator[pa.RecordBatch], shingle: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by task: each task's texts, once each, and the links to the first text of their component."""
    task, keys, sets = None, [], []

    def links() -> pa.RecordBatch:
        a, b = [], []
        if len(sets) > 1:
            for i, first in enumerate(_components(sets, percent)):
                if i != first:
                    a.append(keys[i])
                    b.append(keys[first])
        return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], schema=FOUND)

    for batch in batches:
        names, texts = batch.column(1).to_pylist(), folded(batch.column(2))
        for now, key, text in zip(batch.column(0).to_pylist(), names, texts, strict=True):
            if now != task:
                yield links()
                task, keys, sets = now, [], []
            if not keys or keys[-1] != key:
                keys.append(key)
                sets.append(shingle_set(text.split(), shingle))
    yield links()


def _candidates(texts: DataFrame) -> DataFrame:
    """Links from each member of a table entry to its smallest member."""
    first = texts.select("text_key", F.explode("first").alias("key"))
    shared = first.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    met = first.join(shared, "key").join(texts.select("text_key", "second"), "text_key")
    entries = met.select("text_key", F.col("key").alias("one"), F.explode("second").alias("two")).select(
        "text_key", F.xxhash64("one", "two").alias("entry")
    )
    entries = staged(entries, "entries")
    hubs = entries.groupBy("entry").agg(F.min("text_key").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return (
        entries.join(hubs, "entry").where("text_key != hub")
        .select(F.col("text_key").alias("a"), F.col("hub").alias("b")).distinct()
    )


def near_duplicates(
    docs: DataFrame,
    percent: int = PERCENT,
    shingle: int = SHINGLE,
    tables: int = TABLES,
    rows: int = ROWS,
    task_shingles: int = TASK_SHINGLES,
) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): n_shingles, component_id, component, kept, raw_key, first_of.

    ``component_id`` is the smallest doc_id reachable over links, ``component`` a
    key of the group; ``kept`` says that the row bears the smallest id.
    ``first_of`` marks the rows that stay when one row of each group stays: those
    with the smallest (doc_id, raw_key), where raw_key is a hash of the raw text.
    A text without words is linked with nothing: its component is itself and it is
    kept.  Null ids are larger than any other; a group of them has a null
    component_id and its rows are kept only by ``first_of``.  Rows repeated exactly
    get equal results.  An empty table gives an empty result; other columns are
    not read.
    """
    work = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("raw_key"),
        F.col("text").cast("string").alias("text"),
    )
    signed = staged(work.mapInArrow(lambda b: _signed(b, shingle, tables, rows), SIGNED), "signatures")
    texts = signed.where("n_shingles > 0").dropDuplicates(["text_key"])
    blocks = staged(connected(_candidates(texts)), "blocks")

    # The first row of each text in a block stands for it.
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "raw_key")
    chosen = (
        signed.join(blocks, signed["text_key"] == blocks["node"])
        .groupBy("root", "text_key")
        .agg(F.min(place).alias("at"), F.first("n_shingles").alias("n_shingles"))
    )
    chosen = staged(chosen, "chosen")
    sizes = chosen.groupBy("root").agg(F.sum("n_shingles").alias("held"))
    parts = F.greatest(F.ceil(2 * F.col("held") / task_shingles), F.lit(1)).cast("int")
    cut = sizes.select("root", F.when(F.col("held") <= task_shingles, F.lit(1)).otherwise(parts).alias("parts"))
    part = F.pmod(F.xxhash64("text_key"), F.col("parts")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda other: F.struct(F.least("part", other).alias("low"), F.greatest("part", other).alias("high")),
    )
    tasks = (
        chosen.join(cut, "root").withColumn("part", part)
        .select(
            "text_key", F.col("at.doc_id").alias("id"), F.col("at.raw_key").alias("key"), "root",
            F.explode(pairs).alias("pair"),
        )
        .select("text_key", "id", "key", F.concat_ws("/", F.hex("root"), "pair.low", "pair.high").alias("task"))
    )
    links = (
        # The chosen texts grow with the input, so they are never broadcast.
        work.join(tasks.hint("merge"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("raw_key") == F.col("key")))
        .select("task", "text_key", "text")
        .repartition("task")
        .sortWithinPartitions("task", "text_key")
        .mapInArrow(lambda b: _searched(b, shingle, percent), "a binary, b binary")
    )
    roots = connected(links).select(F.col("node").alias("text_key"), "root")
    grouped = signed.select("doc_id", "raw_key", "n_shingles", "text_key").join(roots, "text_key", "left").select(
        "doc_id", "raw_key", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.coalesce("root", "text_key")).alias("component"),
    )
    grouped = staged(grouped, "grouped")
    least = grouped.where("component is not null").groupBy("component").agg(F.min(place).alias("least"))
    return grouped.join(least, "component", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"),
        "component",
        (F.col("component").isNull() | F.coalesce(F.col("doc_id") == F.col("least.doc_id"), F.lit(False))).alias("kept"),
        "raw_key",
        (F.col("component").isNull() | (place == F.col("least"))).alias("first_of"),
    )


def one_of_each(
    docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, tables: int = TABLES
) -> DataFrame:
    """``docs`` with all its columns, one row of each group of near duplicates; texts without words all stay."""
    marked = staged(near_duplicates(docs, percent, shingle, tables), "near-duplicates")
    keys = ["doc_id", "raw_key"]
    dropped = marked.where("not first_of").select(*keys).distinct()
    again = marked.where("first_of and component is not null").groupBy(*keys).count().where("count > 1").select(*keys)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("id"),
        F.xxhash64(F.col("text").cast("string")).alias("key"),
    )
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("raw_key"))
    single = rows.join(dropped.union(again), same, "left_anti").select("row.*")
    repeated = rows.join(again, same, "left_semi").dropDuplicates(["id", "key"]).select("row.*")
    return single.union(repeated)
