"""Near-duplicate groups by SimHash and multi-index hashing.

1. A text becomes a 64-bit fingerprint: a bit is set if it is set in over half the hashes of the text's
   3-word shingles. Equal fingerprints are one node from then on, so copies cost nothing.
2. Two fingerprints that differ in at most three bits differ in at most one bit in one of their two halves.
   Each half is a table: a fingerprint is entered under its half, and looked up under the half and under the
   half with one more bit set. Of two halves that differ in one bit, one has that bit clear, so looking up in
   this direction alone finds every pair.
3. What meets under a key is verified on all 64 bits. A search over the rows of the key returns one link for
   each row reached, not all pairs, so links grow with the rows.
4. A key with more than ``most_entries`` entries is looked up anew by the halves of the bits that its entries
   do not share, and again until few share a key or no bits are left to split.

Nothing is missed and nothing is collected: connected components of the links are the groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from . import frames, text as T
from .components import components

#: Differing bits of linked fingerprints; two halves find up to three.
DISTANCE = 3
SEED = 42
SHINGLE = 3


@dataclass(frozen=True)
class Settings:
    #: Entries under one key that a task compares; keys with more are split by further bits.
    most_entries: int = 4096
    #: Fewest bits that a further split looks at.
    least_bits: int = 4


def _flat(data: bytes) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Words of ``data`` joined by single spaces, where each begins and ends there, and where it began in ``data``."""
    a = np.frombuffer(data, dtype=np.uint8)
    space = T._is_space()[a]
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    keep = ~space
    keep[ends[ends < len(a)]] = True
    flat = a[keep].copy()
    flat[space[keep]] = 32
    sizes = ends - starts
    at = np.cumsum(sizes + 1) - sizes - 1
    return flat.tobytes(), at, at + sizes, starts


def _hashes(flat: bytes, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    one = xxhash.xxh64_intdigest
    return np.fromiter((one(flat[i:j], SEED) for i, j in zip(first.tolist(), last.tolist())), np.uint64, len(first))


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each bit set, lowest bit first."""
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = np.ascontiguousarray(hashes[at : at + (1 << 14)], dtype="<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return total


def _majority(counts: np.ndarray, n: int) -> int:
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _long_print(data: bytes) -> int:
    """Fingerprint of one text of any length, part by part; the last two words of a part go before the next."""
    counts, n, carry = np.zeros(64, dtype=np.int64), 0, b""
    for part in T.cut(data):
        flat, first, last, _ = _flat(carry + b" " + part)
        if len(first) >= SHINGLE:
            hashes = _hashes(flat, first[: 1 - SHINGLE], last[SHINGLE - 1 :])
            counts += _bit_counts(hashes)
            n += len(hashes)
        carry = flat[first[max(0, len(first) - SHINGLE + 1)] : last[-1]] if len(first) else b""
    if not n and carry:
        counts, n = _bit_counts(_hashes(carry, np.array([0]), np.array([len(carry)]))), 1
    return _majority(counts, n)


def text_prints(texts: list[bytes]) -> list[int]:
    """Unsigned fingerprints of lower-cased texts; without words: zero."""
    if len(texts) == 1 and len(texts[0]) > T.BUFFER_BYTES:
        return [_long_print(texts[0])]
    flat, first, last, starts = _flat(b"\n".join(texts))
    lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    bounds = np.searchsorted(starts, np.concatenate(([0], np.cumsum(lengths))))
    places, owner = T.window_places(bounds, SHINGLE)
    hashes = _hashes(flat, first[places], last[places + SHINGLE - 1])
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = []
    for k in range(len(texts)):
        here = hashes[cuts[k] : cuts[k + 1]]
        if not len(here) and bounds[k + 1] > bounds[k]:
            here = _hashes(flat, first[bounds[k] : bounds[k] + 1], last[bounds[k + 1] - 1 : bounds[k + 1]])
        out.append(_majority(_bit_counts(here), len(here)))
    return out


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id`` and ``fp`` (the fingerprint's bits as a signed long) for every row of ``docs``.

    A null text, or one without words, has fingerprint zero; one of fewer than three words has that of its whole
    sequence. Repeated rows and null keys stay. An empty table gives an empty one.
    """

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for first, texts in T.buffers(batch.column(1)):
            prints = np.array(text_prints([t.lower() for t in texts]), dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.array(prints)], names=["id", "fp"])

    slim = docs.select(F.col(key).cast("long").alias("id"), T.utf8(text).alias("data"))
    return T.map_batches(slim, work, "id long, fp long")


def _entries(rows: DataFrame, bits: int) -> DataFrame:
    """Look-ups of rows ``bucket``, ``fp``, ``low`` in both halves of the ``2 * bits`` fingerprint bits from ``low`` on.

    Gives ``bucket``, ``own`` (an entry of the table, not just a look-up), ``fp`` and the first bit ``low`` of the
    bits that entries of the new bucket do not share.
    """
    looked = []
    for half in (0, 1):
        at = f"low + {half * bits}"
        value = f"(shiftrightunsigned(fp, {at}) & {(1 << bits) - 1}L)"
        ball = ", ".join(f"{value} | {1 << k}L" for k in range(bits))
        keys = f"array_distinct(array({value}, {ball}))"
        looked.append(
            f"transform({keys}, v -> struct(xxhash64(bucket, low, {half}, v) AS bucket, v = {value} AS own, low + {(1 - half) * bits} AS low))"
        )
    return rows.select("fp", F.explode(F.expr(f"concat({', '.join(looked)})")).alias("e")).select("e.bucket", "e.own", "fp", "e.low")


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x[:, None] ^ y[None, :]) > DISTANCE


def _search(fp: np.ndarray, own: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links that connect what is connected under one key: each row reached and the row its search began from.

    A link has a table entry on one side at least: two look-ups need not be compared here.
    """
    a, b = [], []
    entries, lookups = fp[own], fp[~own]
    while len(entries) and len(entries) + len(lookups) > 1:
        root, front, entries = entries[:1], [(entries[:1], True)], entries[1:]
        while front:
            now, table = front.pop()
            step = max(1, (1 << 20) // max(1, len(entries) + len(lookups)))
            if len(now) > step:
                front.append((now[step:], table))
                now = now[:step]
            far = _apart(now, entries).all(axis=0)
            met = [(entries[~far], True)]
            entries = entries[far]
            if table:
                far = _apart(now, lookups).all(axis=0)
                met.append((lookups[~far], False))
                lookups = lookups[far]
            for reached, kind in met:
                if len(reached):
                    a.append(reached)
                    b.append(np.broadcast_to(root, reached.shape))
                    front.append((reached, kind))
    return a, b


def _linked(entries: DataFrame) -> DataFrame:
    """Links (a, b) under each bucket of ``entries``, at most one for each row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def links(bucket: np.ndarray, own: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            edge = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
            first, size = edge[:-1], np.diff(edge)
            # Two rows: one comparison for all such buckets at once.
            two = first[(size == 2)]
            two = two[(own[two] | own[two + 1]) & (np.bitwise_count(fp[two] ^ fp[two + 1]) <= DISTANCE)]
            a, b = [fp[two + 1]], [fp[two]]
            for at, n in zip(first[size > 2].tolist(), size[size > 2].tolist()):
                got = _search(fp[at : at + n], own[at : at + n])
                a += got[0]
                b += got[1]
            pair = [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)]
            yield pa.RecordBatch.from_arrays(pair, names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            now = [
                batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy().view(np.uint64)
            ]
            held = [np.concatenate(pair) for pair in zip(held, now)] if held else now
            # The last bucket may go on in the next batch.
            end = int(np.searchsorted(held[0], held[0][-1]))
            if end:
                yield from links(*(c[:end] for c in held))
                held = [c[end:] for c in held]
        if held:
            yield from links(*held)

    parts = entries.select("bucket", "own", "fp").repartition("bucket").sortWithinPartitions("bucket", "fp", "own")
    return parts.mapInArrow(work, "a long, b long")


def links(prints: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Links (a, b) between fingerprints ``fp`` that connect all within three bits of each other.

    ``prints`` has distinct values of ``fp``. Fingerprints without a partner are left out.
    """
    found, bits = [], 32
    rows = prints.select(F.lit(0).cast("long").alias("bucket"), "fp", F.lit(0).alias("low"))
    while True:
        entries = _entries(rows, bits)
        if bits // 2 < settings.least_bits:
            found.append(frames.materialize(_linked(entries)))
            break
        large = frames.materialize(
            entries.where("own").groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > settings.most_entries).select("bucket")
        )
        if large.isEmpty():
            found.append(frames.materialize(_linked(entries)))
            break
        entries = frames.written(entries, "entries")
        marked = frames.written(frames.hot_join(entries, large.withColumn("large", F.lit(True)), ["bucket"], ["fp"], "left"), "marked")
        found.append(frames.materialize(_linked(marked.where("large IS NULL"))))
        rows, bits = marked.where("large").select("bucket", "fp", "low"), bits // 2
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Per row of ``docs``: ``key``, ``fp``, ``fingerprint`` (16 hex digits) and ``component_id``.

    ``component_id`` is the smallest key reachable by links. Texts without words share fingerprint zero and are
    linked like any other. Repeated rows give equal rows. Rows without a key take part; a group in which no row
    has one has a null ``component_id``. Further columns, whatever their names, are left out.
    """
    prints = frames.written(fingerprints(docs, key, text), "fingerprints")
    groups = frames.materialize(prints.groupBy("fp").agg(F.min("id").alias("least")))
    found = components(links(groups.select("fp"), settings)).withColumnRenamed("node", "fp")
    named = frames.materialize(
        groups.join(found, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    )
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    roots = frames.materialize(frames.hot_join(named, least, ["component"], ["fp"], "inner").select("fp", "component_id"))
    rows = frames.hot_join(prints, roots, ["fp"], ["id"], "inner")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.select(F.col("id").alias(key), "fp", digits.alias("fingerprint"), "component_id")
