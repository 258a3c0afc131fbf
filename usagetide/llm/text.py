"""Vectorised word hashing inside Python tasks, and small Arrow helpers.

A word is a run of bytes other than the six ASCII white-space characters. Each
word becomes a 64-bit hash: two of n different words share one with a chance of
about n^2 / 2^65. Work goes through buffers of about a megabyte, so memory does
not depend on how many rows an Arrow batch holds; a text longer than that is cut
at white space.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BUFFER_BYTES = 1 << 20
SPACE = b" \t\n\r\x0b\x0c"
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_state: dict[str, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers (the splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the multiplier and of its inverse, modulo 2^64."""
    if "up" not in _state or len(_state["up"]) <= n:
        size = max(n + 1, BUFFER_BYTES + 4096)
        for name, base in (("up", _MULTIPLIER), ("down", _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _state[name] = np.multiply.accumulate(steps)
    return _state["up"], _state["down"]


def _byte_values() -> np.ndarray:
    if "bytes" not in _state:
        _state["bytes"] = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    return _state["bytes"]


def _is_space() -> np.ndarray:
    if "space" not in _state:
        table = np.zeros(256, dtype=bool)
        table[list(SPACE)] = True
        _state["space"] = table
    return _state["space"]


def hash_buffer(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every word of ``data``."""
    a = np.frombuffer(data, dtype=np.uint8)
    edge = np.diff(np.concatenate(([False], ~_is_space()[a], [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers(len(a))
    total = np.zeros(len(a) + 1, dtype=np.uint64)
    np.cumsum(_byte_values()[a] * up[: len(a)], out=total[1:])
    return mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts, ends


def cut(data: bytes, size: int = BUFFER_BYTES) -> Iterator[bytes]:
    """``data`` in parts of about ``size`` bytes that never split a word."""
    at = 0
    while len(data) - at > size:
        end = at + size
        while end < len(data) and data[end] not in SPACE:
            end += 1
        yield data[at:end]
        at = end
    yield data[at:]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row, and where each text begins (one entry more than texts)."""
    if len(texts) == 1 and len(texts[0]) > BUFFER_BYTES:
        hashes = np.concatenate([hash_buffer(part)[0] for part in cut(texts[0])])
        return hashes, np.array([0, len(hashes)])
    hashes, starts, _ = hash_buffer(b"\n".join(texts))
    lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    return hashes, np.searchsorted(starts, np.concatenate(([0], np.cumsum(lengths))))


def windows(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``width``-word windows inside single texts, and the text each belongs to.

    The result is in reading order; a window's first word is at the place returned by ``window_places``.
    """
    places, owner = window_places(bounds, width)
    value = np.zeros(len(places), dtype=np.uint64)
    for k in range(width):
        value = value * np.uint64(0xC6A4A7935BD1E995) + hashes[places + k]
    return mix64(value + np.uint64(width)), owner


def window_places(bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First word of every window that lies inside one text, and that text's number."""
    counts = np.maximum(np.diff(bounds) - width + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(bounds[:-1], counts) + inside, owner


def buffers(column: pa.Array, size: int = BUFFER_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of a binary column, about ``size`` bytes at a time; null becomes empty."""
    first, held, texts = 0, 0, []
    for i, value in enumerate(column):
        data = value.as_py() or b""
        if texts and held + len(data) > size:
            yield first, texts
            first, held, texts = i, 0, []
        texts.append(data)
        held += len(data) + 1
    if texts:
        yield first, texts


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` for a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from work(batch)

    return df.mapInArrow(run, schema)


def utf8(name: str):
    """The text's bytes; a null text stays null."""
    return F.col(name).cast("binary")


def fold(key: str, parts: int):
    """crc32 of the key as text, modulo ``parts``; a null key falls into fold 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(parts)), F.lit(0)).cast("int")
