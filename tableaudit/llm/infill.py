"""Fill-in-middle over seekable compressed texts.

``store`` keeps each text as zstandard frames that can be read on their own, with
running counts of the units and code points before each.  A unit is a run of
other characters with the white space before it; white space that ends a text is
one more.  ``infill`` finds the frame of a cut in the running counts and unpacks
that one alone; all other frames move to the output as they are.  Digests stream
the frames in order, so no step holds more than one row of packed frames and one
unpacked frame.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableaudit.llm.common import staged

FRAME_BYTES = 64 << 10
SEED = 42
CHANGED_PERCENT, SUFFIX_FIRST_PERCENT = 50, 80
# The marks of the parts, and the order in which each form has them.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
_RUN = re.compile(rb"[^\x20\x09-\x0D]+")
_SPACE = b" \t\n\x0b\x0c\r"
_ROWS = 256

_FRAME = pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("data", pa.binary())])
_STORE = pa.schema(
    [
        ("doc_id", pa.int64()), ("key", pa.string()), ("n", pa.int64()), ("marked", pa.bool_()),
        ("frames", pa.list_(_FRAME)),
    ]
)
STORE = "doc_id long, key string, n long, marked boolean, frames array<struct<units:long, chars:long, data:binary>>"
_OUTPUT = pa.schema(
    [
        ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
        ("middle_chars", pa.int64()), ("output", pa.list_(pa.binary())),
    ]
)
OUTPUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output array<binary>"


def pieces(raw: bytes, size: int) -> Iterator[bytes]:
    """The text in parts of about ``size`` bytes, cut between code points."""
    start = 0
    while start < len(raw):
        end = min(start + size, len(raw))
        while end < len(raw) and raw[end] & 0xC0 == 0x80:
            end += 1
        yield raw[start:end]
        start = end


def framed(raw: bytes, size: int, pack) -> tuple[int, list[dict]]:
    """The number of units, and the frames with the units that end and the code points that lie before each."""
    frames, units, chars, at = [], 0, 0, 0
    for piece in pieces(raw, size):
        frames.append({"units": units, "chars": chars, "data": pack(piece)})
        at += len(piece)
        # A run that goes on in the next frame ends there.
        open_end = at < len(raw) and piece[-1] not in _SPACE and raw[at] not in _SPACE
        units += len(piece.split()) - open_end
        chars += len(piece.decode())
    return units + (bool(raw) and raw[-1] in _SPACE), frames


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while part := list(islice(rows, _ROWS)):
        yield pa.RecordBatch.from_pylist(part, schema=schema)


def store(docs: DataFrame, key: Column | None = None, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Each text (doc_id, text) as seekable frames; ``key`` is what its cuts are drawn from, by default the doc_id.

    Null texts are empty and have no frame.  Other columns are not read; an empty table gives no rows.
    """
    shown = F.coalesce(F.col("doc_id").cast("string"), F.lit("")) if key is None else key

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)

        def rows() -> Iterator[dict]:
            for batch in batches:
                for i in range(batch.num_rows):
                    raw = batch.column(2)[i].as_py() or b""
                    n, frames = framed(raw, frame_bytes, packer.compress)
                    marked = any(m in raw for m in (PREFIX, SUFFIX, MIDDLE))
                    yield {
                        "doc_id": batch.column(0)[i].as_py(), "key": batch.column(1)[i].as_py(), "n": n,
                        "marked": marked, "frames": frames,
                    }

        yield from _batches(rows(), _STORE)

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), shown.alias("key"),
        F.col("text").cast("string").cast("binary").alias("text"),
    ).mapInArrow(pack, STORE)


def draws(key: Column, seed: int) -> list[Column]:
    """Four numbers below 2**32 from the SHA-256 of ``seed:key``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), key), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


class _Text:
    """One stored text, of which frames are unpacked as they are asked for."""

    def __init__(self, frames: list[dict], n: int, reader, packer) -> None:
        self.frames, self.n, self.reader, self.packer = frames, n, reader, packer
        self.units = [f["units"] for f in frames]

    def _frame(self, at: int) -> bytes:
        return self.reader.decompress(self.frames[at]["data"])

    def cut(self, k: int) -> tuple[int, int, int]:
        """(frame, byte in it, code points before) of the place after ``k`` units."""
        if k == 0:
            return 0, 0, 0
        # The last frame with fewer than k units before it holds the end of unit k.
        at = bisect_left(self.units, k) - 1
        raw = self._frame(at)
        run = next(islice(_RUN.finditer(raw), k - self.units[at] - 1, None), None)
        end = run.end() if run else len(raw)
        return at, end, self.frames[at]["chars"] + len(raw[:end].decode())

    def part(self, start: tuple[int, int], end: tuple[int, int] | None) -> list[bytes]:
        """The frames between two places; only those that a place cuts are packed anew."""
        stop = end or (len(self.frames), 0)
        out = []
        for at in range(start[0], min(stop[0] + 1, len(self.frames))):
            low = start[1] if at == start[0] else 0
            if low == 0 and at < stop[0]:
                out.append(self.frames[at]["data"])
                continue
            raw = self._frame(at)
            if piece := raw[low : stop[1] if at == stop[0] else len(raw)]:
                out.append(self.packer.compress(piece))
        return out


def infill(
    stored: DataFrame,
    seed: int = SEED,
    changed_percent: int = CHANGED_PERCENT,
    suffix_first_percent: int = SUFFIX_FIRST_PERCENT,
) -> DataFrame:
    """doc_id, n units, form, prefix_chars, middle_chars, output (frames) of each stored text.

    Two draws cut the text into prefix, middle and suffix.  A text is left plain
    where it is empty, holds one of the marks, or its third draw says so; the
    fourth chooses between both orders.  Joined frames are the output's bytes.
    Repeated rows give repeated results.
    """
    row = stored.select("doc_id", "n", "marked", "frames", *[h.alias(f"h{i + 1}") for i, h in enumerate(draws(F.col("key"), seed))])

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, packer = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=3)
        marks = {m: packer.compress(m) for m in (PREFIX, SUFFIX, MIDDLE)}

        def rows() -> Iterator[dict]:
            for batch in batches:
                for i in range(batch.num_rows):
                    doc_id, n, marked, frames, h1, h2, h3, h4 = (c[i].as_py() for c in batch.columns)
                    out = {"doc_id": doc_id, "n": n, "form": "plain", "prefix_chars": None, "middle_chars": None}
                    if not frames or marked or h3 % 100 >= changed_percent:
                        yield out | {"output": [f["data"] for f in frames]}
                        continue
                    text = _Text(frames, n, reader, packer)
                    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
                    (*a, chars_a), (*b, chars_b) = text.cut(low), text.cut(high)
                    part = {PREFIX: text.part((0, 0), a), MIDDLE: text.part(a, b), SUFFIX: text.part(b, None)}
                    form = "spm" if h4 % 100 < suffix_first_percent else "psm"
                    yield out | {
                        "form": form, "prefix_chars": chars_a, "middle_chars": chars_b - chars_a,
                        "output": [f for m in ORDERS[form] for f in (marks[m], *part[m])],
                    }

        yield from _batches(rows(), _OUTPUT)

    return row.mapInArrow(change, OUTPUT)


def stream(frames: list[bytes], reader) -> Iterator[bytes]:
    return map(reader.decompress, frames)


def places(frames: list[bytes], marks: tuple[bytes, ...], reader) -> tuple[str, list[int], list[int]]:
    """The SHA-256 of the whole output, the first byte of each mark in order, and where each frame starts."""
    digest, found, starts, at, tail = hashlib.sha256(), [], [], 0, b""
    for piece in stream(frames, reader):
        digest.update(piece)
        starts.append(at)
        # The last two bytes before a frame may begin a mark that ends in it.
        window, first, seen = tail + piece, at - len(tail), 0
        while len(found) < len(marks) and (hit := window.find(marks[len(found)], seen)) >= 0:
            found.append(first + hit)
            seen = hit + len(marks[len(found) - 1])
        at += len(piece)
        # Bytes of a mark already found are not looked at again.
        tail = window[max(seen, len(window) - 2) :]
    return digest.hexdigest(), found, [*starts, at]


def restored(frames: list[bytes], form: str, reader) -> tuple[str, str]:
    """SHA-256 of an output, and of the text rebuilt from the output and its form, both streamed."""
    marks = ORDERS.get(form, ())
    digest, found, starts = places(frames, marks, reader)
    if form == "plain":
        return digest, digest
    ends = [*found[1:], starts[-1]]
    part = {m: (at + len(m), end) for m, at, end in zip(marks, found, ends, strict=True)}
    text = hashlib.sha256()
    for mark in (PREFIX, MIDDLE, SUFFIX):
        low, high = part[mark]
        for at, frame in enumerate(frames):
            if starts[at] < high and starts[at + 1] > low:
                text.update(reader.decompress(frame)[max(low - starts[at], 0) : high - starts[at]])
    return digest, text.hexdigest()


def infill_digest(outputs: DataFrame) -> DataFrame:
    """The columns of ``infill`` with SHA-256 of the output and of the text rebuilt from it, in place of the frames."""
    kept = [f.name for f in _OUTPUT][:-1]
    schema = pa.schema([*[_OUTPUT.field(c) for c in kept], ("output_sha256", pa.string()), ("restored_sha256", pa.string())])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = zstandard.ZstdDecompressor()
        for batch in batches:
            sums = [restored(batch.column(5)[i].as_py(), batch.column(2)[i].as_py(), reader) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array([s[0] for s in sums], pa.string()), pa.array([s[1] for s in sums], pa.string())],
                schema=schema,
            )

    return outputs.mapInArrow(
        check,
        "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string",
    )


def output_texts(outputs: DataFrame) -> DataFrame:
    """doc_id, form and the output as text."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(batch.num_rows):
                text = b"".join(stream(batch.column(2)[i].as_py(), reader)).decode()
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": pa.array([batch.column(0)[i].as_py()], pa.int64()), "form": [batch.column(1)[i].as_py()], "text": [text]}
                )

    return outputs.select("doc_id", "form", "output").mapInArrow(unpack, "doc_id long, form string, text string")


def fill_in_middle(docs: DataFrame, **options) -> DataFrame:
    """``infill`` of documents (doc_id, text) by way of a written frame store."""
    return infill(staged(store(docs), "frames"), **options)
