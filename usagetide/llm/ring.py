"""Shards from a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``vnodes`` points on the ring; the points cut it into arcs, and a key belongs
to the arc that its hash falls in. An arc offers its keys to the shard at its end. A shard takes
keys up to its bound; what overflows continues clockwise to the next point, and so on. Bounds
are exact: they add up to the number of rows and differ by one at most, so every shard ends full
and shard sizes differ by one at most.

How many keys of which arc end where follows from the counts per arc alone. Those counts (as many
as there are points, whatever the data) go to the driver; the rows themselves never do. A row
finds its shard and slot from its rank within its arc.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import frames, text as T

VNODES = 128
#: Rows that one sorted part of an arc should hold; more rows make more parts.
CELL_ROWS = 200_000


def points(shards: int, vnodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Ring positions (unsigned 32-bit, ascending) and the shard of each; a shard's points never depend on the others."""
    shard = np.repeat(np.arange(shards), vnodes)
    copy = np.tile(np.arange(vnodes), shards)
    place = T.mix64((shard.astype(np.uint64) << np.uint64(32)) + copy.astype(np.uint64) + np.uint64(1)) >> np.uint64(32)
    order = np.lexsort((shard, place))
    return place[order].astype(np.int64), shard[order]


def bounds(rows: int, shards: int) -> np.ndarray:
    """Rows each shard may hold."""
    return np.array([rows // shards + (k < rows % shards) for k in range(shards)], dtype=np.int64)


def flow(counts: np.ndarray, owner: np.ndarray, room: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """Segments (arc, first rank, end rank, shard, first slot) that tell where every key of every arc goes.

    Step by step each arc with keys left offers them to the shard of the next point clockwise; within
    a step arcs go in ring order.
    """
    arcs = len(counts)
    left, sent = counts.copy(), np.zeros(arcs, dtype=np.int64)
    room, filled = room.copy(), np.zeros(len(room), dtype=np.int64)
    out = []
    for step in range(arcs):
        waiting = np.flatnonzero(left > 0)
        if not len(waiting):
            break
        for arc in waiting:
            shard = int(owner[(arc + step) % arcs])
            take = int(min(left[arc], room[shard]))
            if take:
                out.append((int(arc), int(sent[arc]), int(sent[arc] + take), shard, int(filled[shard])))
                sent[arc] += take
                left[arc] -= take
                filled[shard] += take
                room[shard] -= take
    return out


def key_hash(key: str, text_hash: Column) -> Column:
    """A hash of the key; rows without a key are spread by their text."""
    return F.when(F.col(key).isNotNull(), F.xxhash64(key)).otherwise(F.xxhash64(text_hash))


def assign(rows: DataFrame, key: str, spread: str, shards: int, vnodes: int = VNODES, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    ``spread`` is a column that tells apart rows whose key is null or repeated. Rows equal in both may
    swap places. Rows should be narrow: they shuffle once by arc. An empty table stays empty. Other columns
    may have any name; ones named ``shard`` or ``slot`` are replaced.
    """
    place, owner = points(shards, vnodes)
    arcs = len(place)
    # The row travels as one struct, so no column of it can clash.
    kept = [rows[c] for c in rows.columns if c not in ("shard", "slot")]
    hashed = rows.select(
        F.struct(*kept).alias("row"), F.col(key).alias("ring_key"), F.col(spread).alias("ring_spread"),
        key_hash(key, F.col(spread)).alias("ring_hash"),
    )

    def find_arc(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        h = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(np.int64)
        position = h.view(np.uint64) >> np.uint64(32)
        arc = np.searchsorted(place, position.astype(np.int64), side="left") % arcs
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(arc.astype(np.int32))], names=[*batch.schema.names, "ring_arc"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in hashed.schema.fields]
    placed = frames.written(T.map_batches(hashed, find_arc, ", ".join([*fields, "ring_arc int"])), "ring")
    found = placed.groupBy("ring_arc").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per ring point
    counts = np.zeros(arcs, dtype=np.int64)
    for r in found:
        counts[r.ring_arc] = r.n
    segments = flow(counts, owner, bounds(int(counts.sum()), shards))
    cells = max(1, -(-int(counts.max()) // cell_rows))
    ranks = frames.ranked(placed, "ring_arc", F.xxhash64("ring_hash", "ring_spread"), ["ring_hash", "ring_key", "ring_spread"], cells, "ring_rank")

    # Segments sorted by arc and first rank: one binary search finds a row's segment.
    by = sorted(segments)
    seg_at = np.array([(s[0] << 40) + s[1] for s in by], dtype=np.int64)
    seg_lo = np.array([s[1] for s in by], dtype=np.int64)
    seg_shard = np.array([s[3] for s in by], dtype=np.int32)
    seg_slot = np.array([s[4] for s in by], dtype=np.int64)

    def look_up(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rank = batch.column("ring_rank").to_numpy()
        arc = batch.column("ring_arc").to_numpy().astype(np.int64)
        at = np.searchsorted(seg_at, (arc << 40) + rank, side="right") - 1
        slot = seg_slot[at] + rank - seg_lo[at]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(seg_shard[at]), pa.array(slot)], names=[*batch.schema.names, "shard", "slot"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in ranks.schema.fields]
    out = T.map_batches(ranks, look_up, ", ".join([*fields, "shard int", "slot long"]))
    return out.select("row.*", "shard", "slot")
