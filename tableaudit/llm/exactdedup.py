"""Exact duplicates by radix tries.

Texts are dealt to owners by length and content hash.  An owner inserts the full
byte strings into a compressed radix trie, so equality is decided by bytes and
never by the hash alone.  Each terminal node keeps the smallest and the largest
identifier of its text and their number.

Only groups whose (length, hash) occurs twice need their bytes compared, so the
bytes of all other rows are never moved.  Before the shuffle, a trie inside each
task reduces its copies to one row per text; the members point at that row.  A
text that owns a third of the table leaves each task once, and its members are
joined over as many keys as there were tasks.  A task's trie that outgrows its
memory gives up its largest subtree, whose texts leave as finished rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableaudit.llm.common import folded, staged

KEEP = ("smallest", "largest")


def _shared_prefix(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving: slices are compared at C speed."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high - 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class Terminal:
    """What a trie keeps of one text."""

    __slots__ = ("count", "largest", "name", "smallest", "text", "tops")

    def __init__(self, name: int, text: bytes) -> None:
        self.name, self.text = name, text
        self.smallest: int | None = None
        self.largest: int | None = None
        self.count = 0
        self.tops: list[int] = []

    def add(self, smallest: int | None, largest: int | None, count: int = 1) -> None:
        if smallest is not None and (self.smallest is None or smallest < self.smallest):
            self.smallest = smallest
        if largest is not None and (self.largest is None or largest > self.largest):
            self.largest = largest
        self.count += count


class RadixTrie:
    """A compressed trie over byte strings: [edge label, children by first byte, terminal]."""

    def __init__(self) -> None:
        self.root: list = [b"", {}, None]
        self.size = 0

    def insert(self, text: bytes, make) -> Terminal:
        """The terminal of ``text``; ``make()`` gives a new one where there is none."""
        node, at = self.root, 0
        while at < len(text):
            child = node[1].get(text[at])
            if child is None:
                child = [text[at:], {}, None]
                node[1][text[at]] = child
                self.size += len(child[0])
                node = child
                break
            label = child[0]
            if text.startswith(label, at):
                node, at = child, at + len(label)
                continue
            cut = _shared_prefix(label, text[at : at + len(label)])
            upper = [label[:cut], {label[cut]: child}, None]
            child[0] = label[cut:]
            node[1][text[at]] = upper
            node, at = upper, at + cut
        if node[2] is None:
            node[2] = make()
        return node[2]

    def cut_largest(self) -> list[Terminal]:
        """Remove the largest subtree below the root and return its terminals."""

        def weigh(top: list) -> tuple[int, list[Terminal]]:
            total, found, todo = 0, [], [top]
            while todo:
                label, children, end = todo.pop()
                total += len(label)
                if end is not None:
                    found.append(end)
                todo.extend(children.values())
            return total, found

        if not self.root[1]:
            return []
        weights = {k: weigh(child) for k, child in self.root[1].items()}
        largest = max(weights, key=lambda k: weights[k][0])
        del self.root[1][largest]
        self.size -= weights[largest][0]
        return weights[largest][1]

    def terminals(self) -> list[Terminal]:
        found, todo = [], [self.root]
        while todo:
            _, children, end = todo.pop()
            if end is not None:
                found.append(end)
            todo.extend(children.values())
        return found


DIGEST = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("digest", pa.binary())])
LOCAL = pa.schema(
    [
        *DIGEST, ("name", pa.int64()), ("top", pa.bool_()), ("smallest", pa.int64()), ("largest", pa.int64()),
        ("count", pa.int64()), ("body", pa.binary()),
    ]
)
OWNED = pa.schema([("name", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("holds", pa.bool_())])


def _digests(batches: Iterator[pa.RecordBatch], bodies: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = folded(batch.column(1))
        columns = [
            batch.column(0),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
        ]
        schema = DIGEST
        if bodies:
            columns.append(pa.array(texts, pa.binary()))
            schema = schema.append(pa.field("body", pa.binary()))
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _local_tries(
    batches: Iterator[pa.RecordBatch], keep: str, memory_bytes: int, memory_rows: int
) -> Iterator[pa.RecordBatch]:
    """A row per document, naming its text's terminal in this task; the row that carries the bytes is an extra one."""
    first = TaskContext.get().partitionId() << 40
    trie, made, waiting = RadixTrie(), 0, {}
    held = 0

    def rows_of(ends: list[Terminal]) -> pa.RecordBatch:
        rows: list[tuple] = []
        for end in ends:
            members, size, digest = waiting.pop(end.name)
            best = end.largest if keep == "largest" else end.smallest
            top = members.index(best)
            rows += [(m, size, digest, end.name, i == top, None, None, None, None) for i, m in enumerate(members)]
            rows.append((None, size, digest, end.name, None, end.smallest, end.largest, end.count, end.text))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), LOCAL, strict=True)]
            if rows
            else [pa.array([], f.type) for f in LOCAL],
            schema=LOCAL,
        )

    for batch in batches:
        ids, sizes, digests, bodies = (c.to_pylist() for c in batch.columns)
        for doc_id, size, digest, body in zip(ids, sizes, digests, bodies, strict=True):
            end = trie.insert(body, lambda text=body, name=first + made: Terminal(name, text))
            if end.name not in waiting:
                made += 1
                waiting[end.name] = ([], size, digest)
            end.add(doc_id, doc_id)
            waiting[end.name][0].append(doc_id)
            held += 1
            while trie.size > memory_bytes and (ends := trie.cut_largest()):
                held -= sum(e.count for e in ends)
                yield rows_of(ends)
        if held > memory_rows:
            yield rows_of(trie.terminals())
            trie, held = RadixTrie(), 0
    yield rows_of(trie.terminals())


def _owner_tries(batches: Iterator[pa.RecordBatch], keep: str) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (length, hash): an owner's trie ends where its key ends."""
    key, trie, names = None, RadixTrie(), {}

    def rows_of() -> list[tuple]:
        out = []
        for end in trie.terminals():
            best = end.largest if keep == "largest" else end.smallest
            holder = next(n for n, lo, hi in names[end.name] if (hi if keep == "largest" else lo) == best)
            out += [(n, best, end.count, n == holder) for n, _, _ in names[end.name]]
        return out

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[]] * len(OWNED)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, OWNED, strict=True)], schema=OWNED
        )

    for batch in batches:
        done: list[tuple] = []
        for size, digest, name, low, high, count, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (size, digest) != key:
                done += rows_of()
                key, trie, names = (size, digest), RadixTrie(), {}
            end = trie.insert(body, lambda name=name: Terminal(name, b""))
            end.add(low, high, count)
            names.setdefault(end.name, []).append((name, low, high))
        yield batch_of(done)
    yield batch_of(rows_of())


def exact_duplicates(
    docs: DataFrame, keep: str = "smallest", memory_bytes: int = 64 << 20, memory_rows: int = 1 << 19
) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with the row that stays of its equal texts.

    Returns doc_id, keep_id, group_size, kept, text_sha256, one row per row.
    Texts are equal when their bytes are, after lower-casing A-Z; null counts as
    empty.  ``keep`` says whether the smallest or the largest doc_id stays.  Of
    rows that share that id, exactly one is kept.  A null id loses against any
    other; a group of null ids keeps one of its rows, with a null keep_id.  An
    empty table gives an empty result; other columns are not read.
    """
    if keep not in KEEP:
        raise ValueError(f"keep must be one of {KEEP}")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shape = "doc_id long, n_bytes long, digest binary"
    narrow = staged(texts.mapInArrow(lambda b: _digests(b, False), shape), "digests")
    counts = narrow.groupBy("n_bytes", "digest").count()
    twice = counts.where("count > 1").select("n_bytes", "digest")
    once = counts.where("count = 1").select("n_bytes", "digest")
    bodies = texts.mapInArrow(lambda b: _digests(b, True), f"{shape}, body binary")
    local = staged(
        bodies.join(twice, ["n_bytes", "digest"], "left_semi")
        .select("doc_id", "n_bytes", "digest", "body")
        .mapInArrow(
            lambda b: _local_tries(b, keep, memory_bytes, memory_rows),
            f"{shape}, name long, top boolean, smallest long, largest long, count long, body binary",
        ),
        "local-tries",
    )
    owned = (
        local.where("count is not null")
        .select("n_bytes", "digest", "name", "smallest", "largest", "count", "body")
        .repartition("n_bytes", "digest")
        .sortWithinPartitions("n_bytes", "digest", "name")
        .mapInArrow(lambda b: _owner_tries(b, keep), "name long, keep_id long, group_size long, holds boolean")
    )
    copies = (
        local.where("count is null")
        .join(owned, "name")
        .select("doc_id", "keep_id", "group_size", (F.col("holds") & F.col("top")).alias("kept"), "digest")
    )
    single = narrow.join(once, ["n_bytes", "digest"], "left_semi").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "digest",
    )
    return copies.union(single).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )
