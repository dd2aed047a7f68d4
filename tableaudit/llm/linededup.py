"""Fuzzy duplicate lines by MinHash.

A line's signature has one hash of its character shingles for each of 64 bins: the
hash range is cut into bins, and a bin's value is the smallest hash at or after its
start, so an empty bin borrows from the next.  Two lines agree on a bin with the
probability of their Jaccard similarity.  ``rows`` bins make a band; with 16 bands
of 4, lines at the threshold of 0.8 miss each other with probability 2e-4, and
lines at 0.9 with 2e-8.

Equal lines are one node from the start.  All lines that meet in a band entry are
compared there, on full shingle sets, by a search in breadth: a line just reached
is compared with every line of the entry not reached yet.  So no pair that the
bands propose is left out, and an entry gives one link per line, not per pair.
Entries of the same lines are searched once, and many entries of two lines at a
time.  An entry over ``part_lines`` is cut into parts, and every pair of parts is
searched in a task of its own.  Distributed
union-find over the links leaves one line of each component.

Signatures and searches run on Arrow batches with numpy: with columns alone the
signatures took more than three times the processor time that the whole may take.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableaudit.llm.common import staged, written
from tableaudit.llm.components import connected
from tableaudit.llm.neardedup import _components
from tableaudit.session import remove_folder, shared_folder

SHINGLE = 7
PERCENT = 80
BANDS, ROWS = 16, 4
PART_LINES = 2000
# Lines signed at once, pairs or groups compared at once, characters of those, texts cut at once, and the size of a
# group that is compared alone.
_LINES, _PAIRS, _CHARS, _TEXTS, _ARRAYS = 128, 64, 1 << 16, 1024, 16
# Buckets of entries for each partition, and entries that a task holds before it sends them.
_BUCKETS, _PACKED = 8, 1 << 20
# Factor of the hash of a shingle, and its inverse modulo 2**64.
_FACTOR = 0x100000001B3
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_KEPT: list[np.ndarray] = []
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else 0x20 if c in (0x09, 0x0D) else c for c in range(256))


def normal_line(line: bytes) -> bytes:
    """A line for comparison: A-Z folded, runs of spaces, tabs and returns as one space, none at the ends."""
    return _tight(line.translate(_FOLD))


def _tight(line: bytes) -> bytes:
    line = line.strip(b" ")
    return b" ".join([w for w in line.split(b" ") if w]) if b"  " in line else line


def _normal_lines(text: bytes) -> Iterator[tuple[int, bytes]]:
    """(number from 0, normal form) of each line that is not blank."""
    for k, line in enumerate(text.translate(_FOLD).split(b"\n")):
        if x := _tight(line):
            yield k, x


def shingles(line: str, n: int = SHINGLE) -> set[str]:
    """The distinct character n-grams; a shorter line is one shingle."""
    return {line[i : i + n] for i in range(len(line) - n + 1)} or {line}


def _mix(h: np.ndarray) -> np.ndarray:
    mixed, shifted = h.copy(), np.empty_like(h)
    for shift, factor in ((31, 0x9E3779B97F4A7C15), (29, 0xBF58476D1CE4E5B9), (32, None)):
        mixed ^= np.right_shift(mixed, np.uint64(shift), out=shifted)
        if factor:
            mixed *= np.uint64(factor)
    return mixed


def _powers(size: int) -> list[np.ndarray]:
    """The powers of the factor and of its inverse, from the first on, ``size`` or more; a worker keeps those it needs often."""
    if size <= 4 * _CHARS and _KEPT:
        return _KEPT
    powers = [np.cumprod(np.full(max(size, 4 * _CHARS), x, np.uint64)) for x in (_FACTOR, _INVERSE)]
    if size <= 4 * _CHARS:
        _KEPT[:] = powers
    return powers


def shingle_hashes(lines: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of the line, 64-bit hash) of every n-gram of lines without line feeds, repeats included."""
    # A short line is filled up with zeros, which stand for no character.
    filled = [x if len(x) >= n else x + "\x00" * (n - len(x)) for x in lines]
    if not filled:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    points = np.frombuffer(("\n".join(filled) + "\n").encode("utf-32-le"), "<u4").astype(np.uint64)
    size = len(points)
    breaks = np.flatnonzero(points == 10)
    # A window's sum of characters times powers of the factor, from running sums times powers of the inverse.
    up, down = _powers(size)
    points += np.uint64(1)
    points *= down[:size]
    running = np.zeros(size + 1, np.uint64)
    np.cumsum(points, out=running[1:])
    sums = running[n:] - running[:-n]
    sums *= up[n - 1 : size]
    # No window holds the end of a line.
    inside = np.ones(len(sums), bool)
    ends = (breaks[:, None] - np.arange(n)).ravel()
    inside[ends[ends < len(sums)]] = False
    windows = np.diff(breaks, prepend=-1) - n
    return np.repeat(np.arange(len(filled)), windows), _mix(sums[inside])


def band_keys(lines: list[str], n: int, bands: int, rows: int) -> np.ndarray:
    """A key for each line and band."""
    owner, hashes = shingle_hashes(lines, n)
    short, bins = hashes >> np.uint64(20), bands * rows
    own = short // np.uint64((1 << 44) // bins)
    place = np.minimum(own, np.uint64(bins - 1), out=own).view(np.int64)
    place += owner * bins
    none = np.uint64((1 << 64) - 1)
    least = np.full(len(lines) * bins, none)
    np.minimum.at(least, place, short)
    least = least.reshape(len(lines), bins)
    # The smallest hash at or after the start of the bin; after the last hash of a line its smallest one counts.
    values = np.minimum.accumulate(least[:, ::-1], axis=1)[:, ::-1]
    values = np.where(values == none, least.min(axis=1)[:, None], values)
    values = values.reshape(len(lines), bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), values.shape[:2]).copy()
    for r in range(rows):
        key = _mix(key) + values[:, :, r]
    return _mix(key).view(np.int64)


def line_components(lines: list[str], n: int, percent: int) -> list[int]:
    """For each line the place of its component's first line."""
    if len(lines) >= _ARRAYS:
        owner, hashes = shingle_hashes(lines, n)
        order = np.lexsort((hashes, owner))
        owner, hashes = owner[order], hashes[order]
        new = np.append(True, (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1]))
        owner, hashes = owner[new], hashes[new]
        cuts = np.searchsorted(owner, np.arange(1, len(lines)))
        return _components(np.split(hashes, cuts), percent).tolist()
    sets = [shingles(x, n) for x in lines]
    root = [-1] * len(sets)
    for first in range(len(sets)):
        if root[first] >= 0:
            continue
        root[first], todo = first, [first]
        while todo:
            a = sets[todo.pop()]
            for other in range(first + 1, len(sets)):
                b = sets[other]
                # Sizes alone rule most pairs out.
                if root[other] < 0 and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                    shared = len(a & b)
                    if 100 * shared >= percent * (len(a) + len(b) - shared):
                        root[other] = first
                        todo.append(other)
    return root


def group_components(groups: list[list[str]], n: int, percent: int) -> list[list[int]]:
    """``line_components`` of each of at most ``_PAIRS`` groups of less than ``_ARRAYS`` lines."""
    owner, hashes = shingle_hashes([x for group in groups for x in group], n)
    # Number of the group, hash and line in one sorted number.
    ends = [(g << 58) | i for g, group in enumerate(groups) for i in range(len(group))]
    mixed = (hashes >> np.uint64(10)) << np.uint64(4)
    mixed |= np.array(ends, np.uint64)[owner]
    mixed.sort()
    line = np.left_shift(1, (mixed & np.uint64(15)).view(np.int64))
    mixed >>= np.uint64(4)
    first = np.flatnonzero(np.append(True, mixed[1:] != mixed[:-1]))
    # For each shingle of a group the lines that have it, as bits.
    having = np.bitwise_or.reduceat(line, first)
    cuts = np.searchsorted(mixed[first], np.arange(1, len(groups), dtype=np.uint64) << np.uint64(54))
    found = []
    for group, own in zip(groups, np.split(having, cuts), strict=True):
        counts = np.bincount(own)
        lines = np.flatnonzero(counts)
        bits = (lines[:, None] >> np.arange(len(group))) & 1
        shared = (bits * counts[lines][:, None]).T @ bits
        size = shared.diagonal()
        over = 100 * shared - percent * (size[:, None] + size - shared)
        linked = over >= 0
        # Two shingles may share a shortened hash: what that could decide is counted on the shingles.
        for i, j in np.argwhere(abs(over) <= 400).tolist():
            if i < j:
                a, b = shingles(group[i], n), shingles(group[j], n)
                linked[i, j] = linked[j, i] = 100 * len(a & b) >= percent * len(a | b)
        found.append([0] * len(group) if linked[0].all() else _reached(linked.tolist()))
    return found


def _reached(linked: list[list[bool]]) -> list[int]:
    """For each line the first one that links lead to."""
    root = [-1] * len(linked)
    for first in range(len(linked)):
        if root[first] < 0:
            root[first], todo = first, [first]
            while todo:
                for other, similar in enumerate(linked[todo.pop()]):
                    if similar and root[other] < 0:
                        root[other] = first
                        todo.append(other)
    return root


def similar_pairs(pairs: list[tuple[str, str]], n: int, percent: int) -> list[bool]:
    """Whether the two lines of each of at most ``_PAIRS`` pairs are similar."""
    owner, hashes = shingle_hashes([x for pair in pairs for x in pair], n)
    # Number of the pair, hash and side in one sorted number.
    pair, side = (owner >> 1).astype(np.uint64), (owner & 1).astype(np.uint64)
    mixed = np.sort((pair << np.uint64(55)) | ((hashes >> np.uint64(10)) << np.uint64(1)) | side)
    mixed = mixed[np.append(True, mixed[1:] != mixed[:-1])]
    pair = (mixed >> np.uint64(55)).astype(np.int64)
    twice = (mixed[:-1] ^ np.uint64(1)) == mixed[1:]
    shared = np.bincount(pair[:-1][twice], minlength=len(pairs))
    union = np.bincount(pair, minlength=len(pairs)) - shared
    over = 100 * shared - percent * union
    found = (over >= 0).tolist()
    # Two shingles may share a shortened hash: what that could decide is counted on the shingles.
    for i in np.flatnonzero(abs(over) <= 400).tolist():
        a, b = (shingles(x, n) for x in pairs[i])
        found[i] = 100 * len(a & b) >= percent * len(a | b)
    return found


def _work(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[bytes]:
    for text in batch.column(column).cast(pa.binary()):
        yield text.as_py() or b""


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, line_no (from 0) and node (MD5 of the normal form) of each non-blank line."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _TEXTS):
                part = batch.slice(at, _TEXTS)
                rows, numbers, nodes = [], [], []
                for i, text in enumerate(_texts(part, 2)):
                    for k, x in _normal_lines(text):
                        rows.append(i)
                        numbers.append(k)
                        nodes.append(hashlib.md5(x).digest())
                own = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(own), part.column(1).take(own), pa.array(numbers, pa.int32()), pa.array(nodes, pa.binary())],
                    names=["doc_id", "text_key", "line_no", "node"],
                )

    return _work(docs).mapInArrow(cut, "doc_id long, text_key long, line_no int, node binary")


def distinct_lines(docs: DataFrame) -> DataFrame:
    """(id, normal): every distinct line once, with a number."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # What a batch repeats leaves it once.
            seen = {x for text in _texts(batch, 0) for _, x in _normal_lines(text)}
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary())], names=["normal"])

    lines = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(cut, "normal binary")
    return lines.distinct().select(F.monotonically_increasing_id().alias("id"), "normal")


def _entries(lines: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """(bucket, entries, ids): an entry for each band of each line, packed by bucket as 64-bit numbers."""
    buckets = _BUCKETS * int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        ids: list[np.ndarray] = []

        def packs() -> pa.RecordBatch:
            entry, line = np.concatenate(keys), np.concatenate(ids)
            bucket = (entry.view(np.uint64) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            entry, line, bucket = entry[order], line[order], bucket[order]
            first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            offsets = pa.py_buffer((np.append(first, len(entry)) * 8).astype(np.int32))
            packed = [pa.Array.from_buffers(pa.binary(), len(first), [None, offsets, pa.py_buffer(x)]) for x in (entry, line)]
            return pa.RecordBatch.from_arrays([pa.array(bucket[first]), *packed], names=["bucket", "entries", "ids"])

        for batch in batches:
            for at in range(0, batch.num_rows, _LINES):
                part = batch.slice(at, _LINES)
                keys.append(band_keys([x.decode() for x in _texts(part, 1)], n, bands, rows).ravel())
                ids.append(np.repeat(part.column(0).to_numpy(), bands))
                if len(keys) * _LINES * bands >= _PACKED:
                    yield packs()
                    keys.clear()
                    ids.clear()
        if keys:
            yield packs()

    return lines.mapInArrow(sign, "bucket int, entries binary, ids binary")


def _met(entries: DataFrame) -> DataFrame:
    """(entry, id): the entries that hold two lines or more."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, packs = None, []

        def shared() -> pa.RecordBatch:
            e, i = (np.frombuffer(b"".join(x), np.int64) for x in zip(*packs, strict=True))
            order = np.argsort(e)
            e, i = e[order], i[order]
            same = e[1:] == e[:-1]
            kept = np.append(False, same) | np.append(same, False)
            return pa.RecordBatch.from_arrays([pa.array(e[kept]), pa.array(i[kept])], names=["entry", "id"])

        for batch in batches:
            for now, *pack in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != bucket and packs:
                    yield shared()
                    packs.clear()
                bucket = now
                packs.append(pack)
        if packs:
            yield shared()

    return entries.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(keep, "entry long, id long")


def _tasks(met: DataFrame, part_lines: int) -> DataFrame:
    """(task, id): what has to be searched together."""
    h = F.xxhash64("id")
    sizes = met.groupBy("entry").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.min("id").alias("low"), F.max("id").alias("high")
    )
    # Similar lines meet in most bands: entries of the same lines are one.
    once = sizes.groupBy("n", "x", "low", "high").agg(F.min("entry").alias("entry")).select("entry", "n")
    cut = once.withColumn("parts", F.ceil(F.col("n") / part_lines).cast("int"))
    part = F.pmod(h, F.col("parts")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda other: F.struct(F.least("part", other).alias("low"), F.greatest("part", other).alias("high")),
    )
    return (
        met.join(cut, "entry").withColumn("part", part)
        .select("id", "entry", F.explode(F.when(F.col("parts") > 1, pairs).otherwise(F.array(F.struct(F.lit(0).alias("low"), F.lit(0).alias("high"))))).alias("pair"))
        .select(F.xxhash64("entry", "pair.low", "pair.high").alias("task"), "id")
    )


def line_links(
    lines: DataFrame, met: DataFrame, percent: int, n: int, part_lines: int = PART_LINES
) -> DataFrame:
    """(a, b): links that join the similar lines of every entry of ``met``, from ``lines`` (id, normal)."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, ids, texts = None, [], []
        a: list[int] = []
        b: list[int] = []
        keys: list[list[int]] = []
        small: list[list[str]] = []
        chars = 0

        def join(own: list[int], roots: list[int]) -> None:
            for i, first in enumerate(roots):
                if i != first:
                    a.append(own[i])
                    b.append(own[first])

        def compare() -> None:
            nonlocal chars
            pairs = [i for i, group in enumerate(small) if len(group) == 2]
            more = [i for i, group in enumerate(small) if len(group) > 2]
            if pairs:
                for i, linked in zip(pairs, similar_pairs([(small[i][0], small[i][1]) for i in pairs], n, percent), strict=True):
                    join(keys[i], [0, 0] if linked else [0, 1])
            if more:
                for i, roots in zip(more, group_components([small[i] for i in more], n, percent), strict=True):
                    join(keys[i], roots)
            keys.clear()
            small.clear()
            chars = 0

        def close() -> None:
            nonlocal chars
            if len(ids) >= _ARRAYS:
                join(ids, line_components(texts, n, percent))
            elif len(ids) > 1:
                keys.append(ids)
                small.append(texts)
                chars += sum(map(len, texts))
                if len(small) == _PAIRS or chars >= _CHARS:
                    compare()

        def rows_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            for now, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _texts(batch, 2), strict=True):
                if now != task:
                    close()
                    task, ids, texts = now, [], []
                if not ids or ids[-1] != key:
                    ids.append(key)
                    texts.append(text.decode())
            yield rows_of()
            a.clear()
            b.clear()
        close()
        compare()
        yield rows_of()

    work = _tasks(met, part_lines).join(lines.hint("merge"), "id").select("task", "id", "normal")
    return work.repartition("task").sortWithinPartitions("task", "id").mapInArrow(search, "a long, b long")


def line_groups(
    docs: DataFrame, percent: int = PERCENT, n: int = SHINGLE, bands: int = BANDS, rows: int = ROWS,
    part_lines: int = PART_LINES,
) -> DataFrame:
    """(node, root) of every line that is linked with another one; a line without a row is alone."""
    spark = docs.sparkSession
    texts, met = shared_folder(spark, "lines"), shared_folder(spark, "line-entries")
    lines = written(distinct_lines(docs), texts)
    entries = written(_met(_entries(lines, n, bands, rows)), met)
    roots = staged(connected(line_links(lines, entries, percent, n, part_lines)), "line-roots")
    named = lines.join(roots, lines["id"] == roots["node"]).select(F.unhex(F.md5("normal")).alias("node"), "root")
    groups = staged(named, "line-groups")
    # The texts are not read again.
    for path in (texts, met):
        remove_folder(spark, path)
    return groups


def marked_lines(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """Every non-blank line: doc_id, text_key, line_no, its group, and whether it stays.

    Of a group the line with the smallest (doc_id, text_key, line_no) stays; a row
    repeated exactly has the same lines in the same places.
    """
    # (A root has 8 bytes and a node 16.)
    named = lines_of(docs).join(groups, "node", "left").select(
        "doc_id", "text_key", "line_no", F.coalesce(F.unhex(F.lpad(F.hex("root"), 16, "0")), "node").alias("group")
    )
    named = staged(named, "line-places")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "line_no")
    # Lines that have their group for themselves need no second look.
    first = named.groupBy("group").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("group_lines"))
    return named.join(first, "group").select(
        "doc_id", "text_key", "line_no", F.hex("group").alias("group"), "group_lines", (place == F.col("first")).alias("stays")
    )


def dedup_lines(
    docs: DataFrame, percent: int = PERCENT, n: int = SHINGLE, bands: int = BANDS, rows: int = ROWS,
    part_lines: int = PART_LINES,
) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): n_lines, n_dropped, n_kept and the text without its dropped lines.

    Lines are cut at line feeds.  Blank lines are never dropped nor compared, and
    count in neither number.  Null texts are empty.  A row repeated exactly is one
    text, whose lines stay in each of its rows; a null id is larger than any other.
    An empty table gives an empty result; other columns are not read.
    """
    marked = marked_lines(docs, line_groups(docs, percent, n, bands, rows, part_lines))
    gone = marked.where("NOT stays").groupBy("doc_id", "text_key").agg(F.collect_set("line_no").alias("gone"))
    gone = gone.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "gone")
    joined = _work(docs).join(gone, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")), "left")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, dropped, texts = [], [], []
            for text, out in zip(_texts(batch, 1), batch.column(2).to_pylist(), strict=True):
                cut, drop = text.split(b"\n"), set(out or ())
                lines.append(sum(bool(x.strip(b" \t\r")) for x in cut))
                dropped.append(len(drop))
                texts.append(b"\n".join([x for i, x in enumerate(cut) if i not in drop]) if drop else text)
            n, gone = np.array(lines, np.int64), np.array(dropped, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(gone), pa.array(n - gone), pa.array(texts, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_lines", "n_dropped", "n_kept", "text"],
            )

    return joined.select("doc_id", "text", "gone").mapInArrow(
        rebuild, "doc_id long, n_lines long, n_dropped long, n_kept long, text string"
    )


def line_digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_lines", "n_dropped", "n_kept", F.sha2("text", 256).alias("text_sha256"))
