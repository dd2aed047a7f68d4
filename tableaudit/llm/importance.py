"""Importance resampling towards a target text collection, over hashed words and word pairs.

Every word and every pair of neighbours falls into a bucket by its CRC-32.  A
broadcast head holds, for frequent words, the CRC of the word and its state after
the joining space, and for frequent pairs the bucket itself.  Features outside
the head take their CRC directly: a word from its bytes, a pair by carrying the
first word's state on by the second.  The head saves work and changes no result,
so its size is a parameter; both ways feed the same exact totals.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableaudit.llm.common import staged

BUCKETS = 10000
SEED = 7
LEAST_WORDS = 20
DRAWN_PERCENT = 25
HEAD_WORDS, HEAD_PAIRS = 4096, 65536
# Counters a task keeps while it looks for frequent words and pairs.
COUNTERS = 1 << 17
# Bytes of words stay, A-Z turn to a-z, all others to spaces.
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
# Texts are coded in groups of about so many bytes; a longer text is a group of its own.
_GROUP_BYTES = 1 << 20
_LONGEST = 64


def _zero_shifts(longest: int) -> np.ndarray:
    """Tables [length, byte, value], as one row, that carry a CRC over ``length`` more bytes, by its four bytes."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    tables = np.empty((longest + 1, 4, 256), np.uint32)
    tables[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(1, longest + 1):
        tables[n] = (tables[n - 1] >> 8) ^ step[tables[n - 1] & 255]
    return tables.ravel()


def joined_crc(first: np.ndarray, second: np.ndarray, length: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """CRC of joined bytes, from the CRC of both and the second's length (within the tables)."""
    out, row = second.copy(), (length << 10).astype(np.int32)
    for byte in range(4):
        out ^= shifts.take(row + (256 * byte) + ((first >> np.uint32(8 * byte)) & np.uint32(255)).astype(np.int32))
    return out


@dataclass(frozen=True)
class Head:
    """Frequent words with their number, CRC and state after a space; frequent pairs as sorted keys with buckets."""

    words: dict[bytes, tuple[int, int, int]]
    pair_keys: np.ndarray
    pair_buckets: np.ndarray


def head_of(words: list[bytes], pairs: list[bytes], buckets: int) -> Head:
    known = {w: (i, crc32(w), crc32(b" ", crc32(w))) for i, w in enumerate(sorted(words))}
    cut = [p.split(b" ") for p in pairs]
    keys = {known[a][0] * len(known) + known[b][0]: crc32(b"%b %b" % (a, b)) % buckets for a, b in cut if a in known and b in known}
    order = sorted(keys)
    return Head(known, np.array(order, np.int64), np.array([keys[k] for k in order], np.int64))


def _groups(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, int, list[bytes]]]:
    """(batch, first row, texts) of groups of rows with a bounded number of bytes; null is empty."""
    for batch in batches:
        part, start, held = [], 0, 0
        for i, text in enumerate(batch.column(column).cast(pa.binary()).to_pylist()):
            if part and held + len(text or b"") > _GROUP_BYTES:
                yield batch, start, part
                part, start, held = [], i, 0
            part.append(text or b"")
            held += len(text or b"")
        if part:
            yield batch, start, part


def _coded(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words, each word's number among them, and each text's number of words."""
    cut = [t.translate(_FOLD).split() for t in texts]
    coded = pa.array(chain.from_iterable(cut), pa.binary()).dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64), np.array([len(c) for c in cut], np.int64)


def _neighbours(counts: np.ndarray) -> np.ndarray:
    """Whether a word, other than the last of all, and the next stand in the same text."""
    total = int(counts.sum())
    same = np.ones(max(total - 1, 0), bool)
    ends = np.cumsum(counts)[counts > 0][:-1] - 1
    same[ends] = False
    return same


def feature_buckets(texts: list[bytes], head: Head, shifts: np.ndarray, buckets: int):
    """(number of words by text, text of each feature, bucket of each feature)."""
    words, at, counts = _coded(texts)
    number, crc, state = np.full(len(words), -1, np.int64), np.empty(len(words), np.uint32), np.empty(len(words), np.uint32)
    for i, word in enumerate(words):
        if known := head.words.get(word):
            number[i], crc[i], state[i] = known
        else:
            crc[i] = value = crc32(word)
            state[i] = crc32(b" ", value)
    length = np.array([len(w) for w in words], np.int64)
    owner = np.repeat(np.arange(len(texts)), counts)
    same = _neighbours(counts)
    a, b = at[:-1][same], at[1:][same]
    pair = np.empty(len(a), np.int64)
    first, second = number[a], number[b]
    both = np.flatnonzero((first >= 0) & (second >= 0)) if len(head.pair_keys) else np.empty(0, np.int64)
    keys = first[both] * len(head.words) + second[both]
    place = np.minimum(np.searchsorted(head.pair_keys, keys), len(head.pair_keys) - 1)
    hit = head.pair_keys[place] == keys
    frequent = np.zeros(len(a), bool)
    frequent[both[hit]] = True
    pair[both[hit]] = head.pair_buckets[place[hit]]
    short = ~frequent & (length[b] <= _LONGEST)
    pair[short] = joined_crc(state[a[short]], crc[b[short]], length[b[short]], shifts) % np.uint32(buckets)
    for i in np.flatnonzero(~frequent & ~short):
        pair[i] = crc32(words[b[i]], int(state[a[i]])) % buckets
    return counts, np.concatenate([owner, owner[:-1][same]]), np.concatenate([crc[at].astype(np.int64) % buckets, pair])


def _lighter(seen: Counter, counters: int) -> Counter:
    """Misra-Gries: take the same amount off every counter until at most half of them are left."""
    off = sorted(seen.values(), reverse=True)[counters // 2]
    return Counter({k: n - off for k, n in seen.items() if n > off})


def frequent_features(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(feature, n): words and pairs with a lower bound of their number in all texts; under b"" the number of words.

    A task keeps at most ``counters`` counters, and counts what a group of texts
    holds more than once, so that rare features never push out frequent ones.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held = Counter(), 0
        for _, _, texts in _groups(batches, 0):
            words, at, counts = _coded(texts)
            held += len(at)
            number = np.bincount(at, minlength=len(words))
            often = np.flatnonzero(number > 1)
            for i, n in zip(often.tolist(), number[often].tolist(), strict=True):
                seen[words[i]] += n
            same = _neighbours(counts)
            keys, n = np.unique(at[:-1][same] * len(words) + at[1:][same], return_counts=True)
            often = n > 1
            for key, k in zip(keys[often].tolist(), n[often].tolist(), strict=True):
                a, b = divmod(key, len(words))
                seen[b"%b %b" % (words[a], words[b])] += k
            if len(seen) > counters:
                seen = _lighter(seen, counters)
        most = [(b"", held), *seen.most_common(counters // 2)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in most], pa.binary()), pa.array([n for _, n in most], pa.int64())], names=["feature", "n"]
        )

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "feature binary, n long")
    return found.groupBy("feature").agg(F.sum("n").alias("n"))


def learn_head(docs: DataFrame, words: int = HEAD_WORDS, pairs: int = HEAD_PAIRS, buckets: int = BUCKETS) -> Head:
    """The head of ``docs``: words that make up at least one in ``words`` of all words, and pairs one in ``pairs``.

    There can be no more than ``words`` and ``pairs`` of them, whatever the data, so they are fetched.
    """
    found = staged(frequent_features(docs), "frequent")
    total = found.where(F.length("feature") == 0).agg(F.sum("n")).first()[0] or 0
    if not total:
        return head_of([], [], buckets)
    pair = F.instr(F.col("feature").cast("string"), " ") > 0
    enough = F.when(pair, F.col("n") * pairs >= total).otherwise(F.col("n") * words >= total)
    top = [(r["pair"], bytes(r["feature"])) for r in found.where((F.length("feature") > 0) & enough).select(pair.alias("pair"), "feature").collect()]
    return head_of([f for p, f in top if not p], [f for p, f in top if p], buckets)


def bucket_totals(docs: DataFrame, head: Head, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket; ``buckets`` numbers are fetched."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shifts, held = _zero_shifts(_LONGEST), np.zeros(buckets, np.int64)
        for _, _, texts in _groups(batches, 0):
            held += np.bincount(feature_buckets(texts, head, shifts, buckets)[2], minlength=buckets)
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(held[used])], names=["bucket", "n"])

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log of how much likelier each bucket is in the target, add-one smoothed, floored."""
    n = len(source)
    big_s, big_t = float(source.sum() + n), float(target.sum() + n)
    ratio = ((target + 1.0) * big_s) / ((source + 1.0) * big_t)
    return np.array([math.floor(1000 * math.log(r)) for r in ratio.tolist()], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, head: Head) -> DataFrame:
    """doc_id, n_words, n_features and weight, the floored mean gain of each text's features (none: 0)."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shifts = _zero_shifts(_LONGEST)
        for batch, start, texts in _groups(batches, 1):
            counts, owner, bucket = feature_buckets(texts, head, shifts, len(gain))
            # Sums of whole numbers far below 2**53 are exact in doubles.
            total = np.bincount(owner, weights=gain[bucket], minlength=len(texts)).astype(np.int64)
            n = np.maximum(2 * counts - 1, 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(start, len(texts)), pa.array(counts), pa.array(n), pa.array(total // np.maximum(n, 1))],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        weigh, "doc_id long, n_words long, n_features long, weight long"
    )


def ranked(rows: DataFrame, order: list, least: int, purpose: str = "ranked") -> DataFrame:
    """``rows`` with ``rank`` 1, 2, 3... in ``order``; null beyond ``least`` rows.

    Rows are sorted by ranges and numbered inside each; one count per range gives
    the ranges' starts.  The numbered rows are written before they are counted,
    as ranges drawn anew would differ.
    """
    names = rows.columns
    schema = rows.schema.simpleString()[len("struct<") : -1]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = 0
        for batch in batches:
            place = pa.array(np.arange(start, start + batch.num_rows, dtype=np.int64))
            start += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, place], names=[*names, "range_id", "place"])

    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("range_id", F.spark_partition_id())
    numbered = staged(dealt.mapInArrow(number, f"{schema}, range_id int, place long"), purpose)
    held = sorted((r["range_id"], r["n"]) for r in numbered.groupBy("range_id").agg(F.count(F.lit(1)).alias("n")).collect())
    starts, before = [], 0
    for range_id, n in held:
        starts.append((range_id, before))
        before += n
    spark = rows.sparkSession
    rank = F.col("start") + F.col("place") + 1
    return numbered.join(F.broadcast(spark.createDataFrame(starts, "range_id int, start long")), "range_id").select(
        *names, F.when(rank <= least, rank).alias("rank")
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = DRAWN_PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
    head: Head | None = None,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row of ``docs`` (doc_id, text).

    The score is the weight plus Gumbel noise drawn from the id, so that the
    highest scores are a draw without replacement by weight.  Of the N rows with
    ``least_words`` words, floor(percent * N / 100) get a rank; others have null.
    Ties go to the smaller id.  Null texts have no words; a null id has the noise
    of an empty one and comes last among ties; an empty table gives no rows;
    other columns are not read.
    """
    head = learn_head(docs, buckets=buckets) if head is None else head
    gain = gains(bucket_totals(docs, head, buckets), bucket_totals(target, head, buckets))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    # The place of a row in the written table tells equal rows apart.
    scored = staged(
        weights(docs, gain, head)
        .withColumn("score", F.col("weight") + noise)
        .withColumn("tie", F.monotonically_increasing_id()),
        "weights",
    )
    able = scored.where(F.col("n_words") >= least_words)
    drawn = able.count() * percent // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("tie")]
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked(able, order, drawn).unionByName(rest).drop("tie")
