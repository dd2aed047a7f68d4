"""Token ids in ORC: run-length coded stripes with row indexes and Bloom filters.

Documents are dealt by ranges of doc_id and encoded in ascending order inside each
range; each range is written as an ORC file.  ORC codes integers in runs, keeps
minima and maxima for every stripe and row group, and a Bloom filter of doc_id,
so readers take stripes in parallel and skip those that cannot hold an id.

The number of ids before a document is the sum over the ranges before its own,
from one row per range, and the running count inside its range.
"""

from __future__ import annotations

import re
import sys
import types
from array import array
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tableaudit.session import shared_folder

END_ID = 1
STRIPE_BYTES = 16 << 20
INDEX_ROWS = 1000
# What a worker keeps of pieces seen before: bytes of each of two generations, and the longest piece kept.
KEPT_BYTES, KEPT_PIECE = 36 << 20, 64
# Bytes that one kept entry costs beside its own.
_ENTRY = 200
# Up to so many ranges their totals are broadcast (12 bytes each).
MOST_RANGES = 1_000_000
_SPACE = re.compile(r"[\t-\r ]+")
# Texts of these characters only are their own normal form once in lower case, and the
# tokenizer's own pre-tokenizer cuts them into these pieces.
_PLAIN = re.compile(r"[\t-\r -~ß-öø-ÿ]*\Z")
_PIECE = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\s0-9a-zß-öø-ÿ]+")


class Encoder:
    """Ids of texts, by way of their pieces.

    The tokenizer drops white space and never joins across it, nor across the
    pieces it cuts first, so a piece's ids do not depend on its neighbours and are
    kept for the next time, up to a bound on bytes.  Chunks between white space
    that hold other characters than those of plain texts go through the tokenizer
    as they are, and so does a whole text in which one of the added tokens may stand.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # What is used again moves to the younger generation.
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.kept = 0
        # Byte-level vocabularies show printable bytes as themselves and the others, in order, from 0x100 on.
        shown = {b: chr(b) for b in (*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100))}
        hidden = [b for b in range(0x100) if b not in shown]
        shown |= {b: chr(0x100 + i) for i, b in enumerate(hidden)}
        self.shown = shown

    def _piece(self, piece: str) -> bytes:
        """The ids of a piece, which is kept."""
        if known := self.young.get(piece):
            return known
        ids = self.old.get(piece)
        if ids is None:
            # Printable ASCII is shown as itself.
            letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.shown)
            ids = array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()
        if len(piece) <= KEPT_PIECE:
            if self.kept > KEPT_BYTES:
                self.old, self.young, self.kept = self.young, {}, 0
            self.young[piece] = ids
            self.kept += len(piece) + len(ids) + _ENTRY
        return ids

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _plain(self, low: str) -> bytes:
        # The younger generation may change within a text; a piece missed for that is found by the other way.
        known = self.young.get
        return b"".join([known(p) or self._piece(p) for p in _PIECE.findall(low)])

    def encode(self, text: str) -> bytes:
        """The ids of a text, as little-endian 32-bit numbers."""
        low = text.lower()
        if any(token in low for token in self.added):
            return self._whole(text)
        if _PLAIN.match(low):
            return self._plain(low)
        # Cut where the tokenizer does, at white space of every kind that is in the text.
        out = []
        for chunk in _SPACE.split(text):
            low = chunk.lower()
            out.append(self._plain(low) if _PLAIN.match(low) else self._whole(chunk))
        return b"".join(out)


def _encoder(path: str) -> Encoder:
    """One encoder per Python worker, which lives longer than a task."""
    kept = sys.modules.setdefault("_token_encoders", types.ModuleType("_token_encoders"))
    if path not in kept.__dict__:
        kept.__dict__[path] = Encoder(path)
    return kept.__dict__[path]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, partitions: int | None = None) -> None:
    """Encode every whole text of ``docs`` (doc_id, text) and write ids to ORC under ``path``.

    Columns: doc_id, range_id and range_start (ids before the document inside its
    range), n_tokens, ids.  Null texts give the end id alone.  Null ids come first,
    ties of an id are ordered by a hash of their text.  An empty table gives files
    without rows.
    """
    work = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.xxhash64(F.col("text").cast("string")).alias("tie"),
    )
    keys = ["doc_id", "tie"]
    dealt = work.repartitionByRange(partitions, *keys) if partitions else work.repartitionByRange(*keys)
    ordered = dealt.sortWithinPartitions(*keys).select("doc_id", F.spark_partition_id().alias("range_id"), "text")
    ids_type = pa.list_(pa.int32())
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("range_id", pa.int32()), ("range_start", pa.int64()), ("n_tokens", pa.int64()),
            ("ids", ids_type),
        ]
    )
    tail = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, start = _encoder(tokenizer), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                coded = [encoder.encode(t or "") + tail for t in part.column(2).to_pylist()]
                sizes = np.array([len(c) // 4 for c in coded], np.int64)
                offsets = np.concatenate([[0], np.cumsum(sizes)])
                values = pa.array(np.frombuffer(b"".join(coded), "<i4"))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array(start + offsets[:-1]), pa.array(sizes),
                        pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values),
                    ],
                    schema=schema,
                )
                start += int(offsets[-1])
        # Workers outlive tasks: between them only the younger generation is kept.
        encoder.old = {}

    (
        ordered.mapInArrow(encode, "doc_id long, range_id int, range_start long, n_tokens long, ids array<int>")
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.stripe.size", str(STRIPE_BYTES))
        .option("orc.row.index.stride", str(INDEX_ROWS))
        .option("orc.compress", "ZSTD")
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids."""
    rows = spark.read.schema(
        "doc_id long, range_id int, range_start long, n_tokens long, ids array<int>"
    ).orc(path)
    totals = rows.groupBy("range_id").agg(F.sum("n_tokens").alias("held"))
    before = F.sum("held").over(Window.orderBy("range_id").rowsBetween(Window.unboundedPreceding, -1))
    starts = totals.select("range_id", F.coalesce(before, F.lit(0).cast("long")).alias("before"))
    # One row per range: far fewer than documents, and without this the ids would be shuffled to meet them.
    if totals.count() <= MOST_RANGES:
        starts = F.broadcast(starts)
    return rows.join(starts, "range_id").select(
        "doc_id", (F.col("before") + F.col("range_start")).alias("start"), "n_tokens", "ids"
    )


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The ids of a few documents; the filter reaches the stripes' minima, maxima and Bloom filters."""
    rows = spark.read.schema("doc_id long, range_id int, range_start long, n_tokens long, ids array<int>").orc(path)
    return rows.where(F.col("doc_id").isin([int(d) for d in doc_ids])).select("doc_id", "n_tokens", "ids")


def ids_crc32(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids as little-endian 32-bit numbers."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            values = np.asarray(lists.flatten()).astype("<u4")
            ends = np.cumsum(np.asarray(batch.column(2)))
            sums = [crc32(values[a:b].tobytes()) for a, b in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True)] if len(ends) else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return tokens.mapInArrow(check, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_digest(docs: DataFrame, tokenizer: str, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """Write the ids to a new folder (or ``path``), read the files back and describe each document from them."""
    spark = docs.sparkSession
    path = path or shared_folder(spark, "tokens")
    write_tokens(docs, path, tokenizer, end_id)
    return ids_crc32(read_tokens(spark, path))
