"""Fill-in-middle over seekable compressed frames.

A text is stored as a row of independent zstandard frames of about ``FRAME_BYTES``. Each frame carries the
units, code points and bytes of the text up to its end, and whether it begins inside a unit. A unit is a run
of ASCII letters or any other single code point. So the place of a unit is found by a search over the
cumulative counts and one decompressed frame, however long the text is, and digests and outputs are made by
going through the frames in order. A frame has its own checksum: a damaged one raises an error.

Outputs are written as such frames too, and the text is rebuilt from them by its markers alone.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from . import text as T

FRAME_BYTES = 1 << 15
LEVEL = 3
#: Markers of prefix, suffix and middle. A text that holds one stays plain.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Percentages of plain texts, and of suffix-first forms among the others.
PLAIN, SUFFIX_FIRST = 10, 20

FRAMES = "array<struct<units: long, chars: long, bytes: long, inside: boolean, data: binary>>"
_ARROW_FRAMES = pa.list_(
    pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("bytes", pa.int64()), ("inside", pa.bool_()), ("data", pa.binary())])
)
_LETTER = np.zeros(256, dtype=bool)
_LETTER[list(range(65, 91)) + list(range(97, 123))] = True


class Frame(NamedTuple):
    """Counts are cumulative to the frame's end; ``inside``: it begins within a unit."""

    units: int
    chars: int
    bytes: int
    inside: bool
    data: bytes


def _starts(data: bytes, inside: bool) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes begin a unit, and which begin a code point."""
    a = np.frombuffer(data, dtype=np.uint8)
    lead = (a & 0xC0) != 0x80
    letter = _LETTER[a]
    follows = np.empty_like(letter)
    follows[:1] = inside
    follows[1:] = letter[:-1]
    return lead & ~(letter & follows), lead


class FrameWriter:
    """Collects bytes and turns them into frames cut between code points."""

    def __init__(self, size: int = FRAME_BYTES) -> None:
        self.size, self.held, self.frames, self.letter = size, bytearray(), [], False
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)

    def write(self, data: bytes) -> None:
        self.held += data
        at = 0
        while len(self.held) - at > self.size:
            end = at + self.size
            # A code point has at most three further bytes; longer runs are no UTF-8 and are cut anywhere.
            while end < min(at + self.size + 3, len(self.held)) and self.held[end] & 0xC0 == 0x80:
                end += 1
            if end == len(self.held):
                break
            self._add(bytes(self.held[at:end]))
            at = end
        del self.held[:at]

    def _add(self, data: bytes) -> None:
        begins, lead = _starts(data, self.letter)
        units, chars, size = self.frames[-1][:3] if self.frames else (0, 0, 0)
        inside = bool(self.letter and _LETTER[data[0]])
        self.frames.append(
            Frame(units + int(begins.sum()), chars + int(lead.sum()), size + len(data), inside, self.packer.compress(data))
        )
        self.letter = bool(_LETTER[data[-1]])

    def finish(self) -> list[Frame]:
        if self.held:
            self._add(bytes(self.held))
            self.held.clear()
        return self.frames


class FrameReader:
    """Seeks in frames; at most one is decompressed at a time."""

    def __init__(self, frames: Sequence[Frame]) -> None:
        self.frames = frames
        self.units, self.chars, self.bytes = frames[-1][:3] if frames else (0, 0, 0)
        self.unpacker = zstandard.ZstdDecompressor()
        self.at, self.open = -1, b""
        self.read = 0

    def frame(self, k: int) -> bytes:
        if k != self.at:
            self.at, self.open = k, self.unpacker.decompress(self.frames[k].data)
            self.read += 1
        return self.open

    def place(self, unit: int) -> tuple[int, int]:
        """Bytes and code points before the given unit (all of them where there is no such unit)."""
        if unit <= 0:
            return 0, 0
        if unit >= self.units:
            return self.bytes, self.chars
        k = bisect_right(self.frames, unit, key=lambda f: f.units)
        units, chars, size = self.frames[k - 1][:3] if k else (0, 0, 0)
        begins, lead = _starts(self.frame(k), self.frames[k].inside)
        at = int(np.flatnonzero(begins)[unit - units])
        return size + at, chars + int(lead[:at].sum())

    def span(self, first: int, last: int) -> Iterator[bytes]:
        """Bytes ``first`` to ``last`` in order, frame by frame."""
        k = bisect_right(self.frames, first, key=lambda f: f.bytes)
        while first < last:
            base = self.frames[k - 1].bytes if k else 0
            part = self.frame(k)[first - base : last - base]
            yield part
            first += len(part)
            k += 1

    def find(self, marker: bytes, first: int) -> int:
        """Place of the next ``marker`` at or after byte ``first``."""
        tail, at = b"", first
        for part in self.span(first, self.bytes):
            joined = tail + part
            hit = joined.find(marker)
            if hit >= 0:
                return at - len(tail) + hit
            at += len(part)
            tail = joined[-(len(marker) - 1) :]
        raise ValueError(f"no {marker!r} in the output")


def _order(form: str) -> tuple[bytes, bytes, bytes]:
    return (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE)


def arrange(frames: Sequence[Frame], draws: Sequence[int], marked: bool) -> tuple[str, int | None, int | None, list[Frame], str]:
    """Form, code points of prefix and middle, output frames and their digest, of one stored text."""
    reader, writer, digest = FrameReader(frames), FrameWriter(), hashlib.sha256()

    def put(parts: Iterator[bytes] | tuple[bytes, ...]) -> None:
        for part in parts:
            writer.write(part)
            digest.update(part)

    h1, h2, h3, h4 = draws
    if not reader.bytes or marked or h3 % 100 >= 100 - PLAIN:
        put(reader.span(0, reader.bytes))
        return "plain", None, None, writer.finish(), digest.hexdigest()
    form = "spm" if h4 % 100 < SUFFIX_FIRST else "psm"
    one, two = sorted((h1 % (reader.units + 1), h2 % (reader.units + 1)))
    (a, a_chars), (b, b_chars) = reader.place(one), reader.place(two)
    spans = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, reader.bytes)}
    for marker in _order(form):
        put((marker,))
        put(reader.span(*spans[marker]))
    return form, a_chars, b_chars - a_chars, writer.finish(), digest.hexdigest()


def rebuilt(output: Sequence[Frame], form: str) -> Iterator[bytes]:
    """The original text, part by part, from an output and its form alone.

    Markers cannot overlap and no text has one, so the first of each kind is the inserted one.
    """
    reader = FrameReader(output)
    if form == "plain":
        yield from reader.span(0, reader.bytes)
        return
    spans, at, order = {}, 0, _order(form)
    for k, marker in enumerate(order):
        first = reader.find(marker, at) + len(marker)
        if k:
            spans[order[k - 1]] = (at, first - len(marker))
        at = first
    spans[order[-1]] = (at, reader.bytes)
    for marker in (PREFIX, MIDDLE, SUFFIX):
        yield from reader.span(*spans[marker])


def _frames(value: pa.Scalar) -> list[Frame]:
    return [Frame(**f) for f in value.as_py() or ()]


def _plain(frames: list[Frame]) -> list[dict]:
    return [f._asdict() for f in frames]


def _groups(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Consecutive rows whose stored frames hold about ``T.BUFFER_BYTES`` together."""
    first, held = 0, 0
    for i in range(len(column)):
        held += sum(len(f["data"]) for f in column[i].as_py() or ())
        if held >= T.BUFFER_BYTES:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(column):
        yield first, len(column)


def store(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``marked`` (the text holds a marker) and ``frames``, one row per row of ``docs``.

    A null text is an empty one and has no frames. Repeated rows and null keys stay as they are; further
    columns, whatever their names, are left out. An empty table gives an empty one.
    """
    kind = docs.schema[key].dataType

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for first, texts in T.buffers(batch.column(1)):
            kept = []
            for data in texts:
                writer = FrameWriter()
                for at in range(0, len(data), T.BUFFER_BYTES):
                    writer.write(data[at : at + T.BUFFER_BYTES])
                kept.append(_plain(writer.finish()))
            marked = [any(m in data for m in (PREFIX, SUFFIX, MIDDLE)) for data in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, len(texts)), pa.array(marked), pa.array(kept, _ARROW_FRAMES)], names=[key, "marked", "frames"]
            )

    slim = docs.select(F.col(key), T.utf8(text).alias(f"{key}_data"))
    return T.map_batches(slim, work, f"`{key}` {kind.simpleString()}, marked boolean, frames {FRAMES}")


def draws(key: str, seed: int = 1) -> list[Column]:
    """Four numbers below 2^32 from the seed and the key as text (a null key: empty text)."""
    hexed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(hexed, 8 * k + 1, 8), 16, 10).cast("long").alias(f"draw_{k}") for k in range(4)]


def transform(stored: DataFrame, key: str = "doc_id", seed: int = 1) -> DataFrame:
    """Fill-in-middle form of every stored text.

    Columns: ``key``, ``n`` (units), ``form`` (plain, psm or spm), ``prefix_chars``, ``middle_chars`` (null if
    plain), ``output`` (frames), ``output_sha256`` and ``restored_sha256`` (of the text rebuilt from output and
    form). An empty text is plain. Every row is treated on its own, so repeated rows give equal rows; a null
    key draws as empty text. Cuts may meet at either end: then prefix, middle or suffix is empty.
    """
    kind = stored.schema[key].dataType
    schema = (
        f"`{key}` {kind.simpleString()}, n long, form string, prefix_chars long, middle_chars long, "
        f"output {FRAMES}, output_sha256 string, restored_sha256 string"
    )
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), _ARROW_FRAMES, pa.string(), pa.string()]

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        marked, frames = batch.column(1), batch.column(2)
        drawn = [batch.column(3 + k).to_pylist() for k in range(4)]
        for first, end in _groups(frames):
            rows = []
            for i in range(first, end):
                kept = _frames(frames[i])
                form, prefix, middle, output, digest = arrange(kept, [d[i] for d in drawn], marked[i].as_py())
                again = hashlib.sha256()
                for part in rebuilt(output, form):
                    again.update(part)
                units = kept[-1].units if kept else 0
                rows.append((units, form, prefix, middle, _plain(output), digest, again.hexdigest()))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, end - first), *columns],
                names=[key, "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "restored_sha256"],
            )

    return T.map_batches(stored.select(F.col(key), "marked", "frames", *draws(key, seed)), work, schema)


def opened(stored: DataFrame, frames: str, name: str) -> DataFrame:
    """``stored`` with the column ``frames`` replaced by its text as binary column ``name``."""
    rest = [c for c in stored.columns if c != frames]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in stored.select(*rest).schema]

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        column = batch.column(len(rest))
        for first, end in _groups(column):
            texts = []
            for i in range(first, end):
                reader = FrameReader(_frames(column[i]))
                texts.append(b"".join(reader.span(0, reader.bytes)))
            kept = [batch.column(k).slice(first, end - first) for k in range(len(rest))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.binary())], names=[*rest, name])

    return T.map_batches(stored.select(*rest, frames), work, ", ".join([*fields, f"`{name}` binary"]))
