"""Near-duplicate groups by b-bit MinHash.

1. Every text becomes its set of 5-word shingles, K minima of that set, band keys over the full minima,
   and a signature of the low b bits of every minimum, packed into 64-bit numbers.
2. Texts with equal sets collapse to one node, so copies cost nothing later.
3. Nodes that share a band are candidates. Similarity is estimated from the signature by counting equal
   b-bit fields, corrected for fields that agree by chance (2^-b). Estimates well below the threshold
   (over four standard deviations) are dropped. Within a band bucket the surviving pairs only link nodes
   to clusters; they are never written out as pairs.
4. Each cluster, cut into blocks of bounded size where it is large, is checked on the full shingle sets.
   Blocks meet by one node of each group first; after that only nodes outside the largest group are repeated.
   Where that would repeat rows more than a few times each, only nodes that share a band meet (or two or three
   bands, where one still leaves a costly cluster), provided that this repeats fewer rows.
   A union-find skips pairs that are already connected, so a group of any size yields a spanning forest
   of exact links, and connected components of those links are the groups.

The chance to miss a link at similarity 0.85 is (1 - 0.85^6)^32, about 3 in 10 million, plus about 1 in
10 thousand for the estimate's margin on links at the very threshold, when no other link connects them.
A link is also missed if it shares only one or two bands and these lead to nothing but costly clusters, which
are cut by up to three: at 0.85 about 5 in 100 thousand links share so few.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import frames, text as T
from .components import components


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    bands: int = 32
    rows: int = 6
    bits: int = 2
    percent: int = 85
    margin: float = 0.13
    #: Nodes of a bucket or cluster, and shingles of a cluster, that a task compares at once; more are cut into blocks.
    bucket_nodes: int = 4096
    block_shingles: int = 1_500_000
    #: Times that the rows of a cluster may be repeated on average before it is cut by bands instead.
    most_copies: int = 16
    seed: int = 3

    @property
    def minima(self) -> int:
        return self.bands * self.rows

    @property
    def longs(self) -> int:
        return -(-self.minima * self.bits // 64)

    @property
    def most_unequal(self) -> int:
        """Unequal fields of a pair whose corrected estimate just reaches the threshold less the margin."""
        chance = 2.0**-self.bits
        low = self.percent / 100 - self.margin
        return int(np.ceil(self.minima * (1 - (chance + (1 - chance) * low))))


#: Nodes without any id of their own get numbers from here on, so they never are the smallest of a group with ids.
NO_ID = 1 << 62
_FIELD = 0x5555555555555555


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each lower-cased text; the whole sequence where it is shorter."""
    hashes, bounds = T.word_hashes(texts)
    value, owner = T.windows(hashes, bounds, width)
    ends = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = []
    for k in range(len(texts)):
        if ends[k + 1] > ends[k]:
            out.append(np.unique(value[ends[k] : ends[k + 1]]))
        elif bounds[k + 1] > bounds[k]:
            n = int(bounds[k + 1] - bounds[k])
            out.append(T.windows(hashes[bounds[k] : bounds[k + 1]], np.array([0, n]), n)[0])
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _minima(s: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    short = (s >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(factors), 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(short), 2048):
        part = short[at : at + 2048]
        np.minimum(best, (part[:, None] * factors[None, :] + shifts[None, :]).min(axis=0), out=best)
    return best


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``id``, ``text_hash``, ``n_shingles``, set identity ``s1``, ``s2``, ``bands`` and ``sig``, one row per document.

    A text without words (or null) has an empty set, no bands and no signature.
    """
    s = settings
    rng = np.random.default_rng(s.seed)
    factors = (rng.integers(0, 1 << 31, s.minima, dtype=np.int64) * 2 + 1).astype(np.uint32)
    shifts = rng.integers(0, 1 << 32, s.minima, dtype=np.int64).astype(np.uint32)
    slim = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("text_hash"), T.utf8(text).alias("data"))

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for first, texts in T.buffers(batch.column(2)):
            sizes, one, two, bands, packed = [], [], [], [], []
            for z in shingle_sets([t.lower() for t in texts], s.shingle):
                sizes.append(len(z))
                if not len(z):
                    one.append(0), two.append(0), bands.append(None), packed.append(None)
                    continue
                one.append(int(np.bitwise_xor.reduce(z).view(np.int64)))
                two.append(int(T.mix64(z * np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64).view(np.int64)))
                m = _minima(z, factors, shifts)
                rows = m.reshape(s.bands, s.rows).astype(np.uint64)
                key_ = np.arange(1, s.bands + 1, dtype=np.uint64)
                for k in range(s.rows):
                    key_ = T.mix64(key_ * np.uint64(0xC6A4A7935BD1E995) + rows[:, k])
                bands.append(key_.view(np.int64).tolist())
                low = (T.mix64(m.astype(np.uint64)) & np.uint64((1 << s.bits) - 1)).astype(np.uint64)
                per = 64 // s.bits
                low = np.concatenate((low, np.zeros(s.longs * per - len(low), np.uint64))).reshape(s.longs, per)
                packed.append(np.bitwise_or.reduce(low << (np.arange(per, dtype=np.uint64) * np.uint64(s.bits)), axis=1).view(np.int64).tolist())
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, len(texts)), batch.column(1).slice(first, len(texts)), pa.array(sizes, pa.int64()),
                 pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(bands, longs), pa.array(packed, longs)],
                names=["id", "text_hash", "n_shingles", "s1", "s2", "bands", "sig"],
            )

    return T.map_batches(
        slim, work, "id long, text_hash long, n_shingles long, s1 long, s2 long, bands array<long>, sig array<long>"
    )


def _unequal(x: Column, y: Column, s: Settings) -> Column:
    """Unequal b-bit fields of two packed signatures (b = 2)."""
    total = F.lit(0)
    for k in range(s.longs):
        d = x[k].bitwiseXOR(y[k])
        total = total + F.bit_count(d.bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseAND(F.lit(_FIELD)))
    return total


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Rows of each run of equal values in the first ``keys`` columns, across batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for at, end in zip(starts, starts[1:]):
            now = tuple(c[at] for c in columns)
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(at, end - at))
            last = now
    if held:
        yield pa.Table.from_batches(held)


def _close(sig: np.ndarray, x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
    """Boolean matrix: which of the places ``x`` (rows) and ``y`` have at most ``most`` unequal fields."""
    left, right = sig[x], sig[y]
    total = np.zeros((len(x), len(y)), dtype=np.uint16)
    for k in range(sig.shape[1]):
        d = left[:, None, k] ^ right[None, :, k]
        total += np.bitwise_count((d | (d >> np.uint64(1))) & np.uint64(_FIELD))
    return total <= most


def _sig_matrix(column: pa.ChunkedArray, longs: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, longs)


def clusters(nodes: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``node`` and ``component``: clusters of nodes joined by shared bands with an estimate near the threshold or above.

    ``nodes`` has ``node``, ``bands`` and ``sig``. Nodes without such a partner are left out.
    """
    s = settings
    members = nodes.select("node", F.explode("bands").alias("bucket"))
    buckets = members.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min("node").alias("a"), F.max("node").alias("b"), F.bit_xor(F.xxhash64("node")).alias("x")
    ).where("n > 1")
    # The same nodes often meet in many bands: one bucket for each membership.
    once = frames.materialize(buckets.groupBy("n", "a", "b", "x").agg(F.min("bucket").alias("bucket")))
    sigs = nodes.select("node", "sig")

    pairs = once.where("n = 2").select("a", "b").distinct()
    left = sigs.select(F.col("node").alias("a"), F.col("sig").alias("sig_a"))
    right = sigs.select(F.col("node").alias("b"), F.col("sig").alias("sig_b"))
    near = pairs.join(left, "a").join(right, "b").where(_unequal(F.col("sig_a"), F.col("sig_b"), s) <= s.most_unequal).select("a", "b")

    # Larger buckets, nearly all of one block.
    blocks = F.ceil(F.col("n") / s.bucket_nodes).cast("int")
    large = members.join(once.where("n > 2").select("bucket", blocks.alias("blocks")), "bucket")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    places = large.select(F.col("bucket").alias("cluster"), "blocks", own.alias("own"), "node", F.lit(0).cast("long").alias("size"))
    most, longs = s.most_unequal, s.longs

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for run in _runs(batches, 3):
            node, first = np.unique(run.column(3).to_numpy(), return_index=True)
            sig = _sig_matrix(run.column(4), longs)[first]
            free = np.arange(len(node))
            while len(free):
                root, front, free = int(node[free[0]]), free[:1], free[1:]
                while len(front) and len(free):
                    step = max(1, (1 << 20) // len(free))
                    part, front = front[:step], front[step:]
                    near_it = _close(sig, part, free, most).any(axis=0)
                    reach, free = free[near_it], free[~near_it]
                    b.extend([root] * len(reach))
                    a.extend(node[reach].tolist())
                    front = np.concatenate((front, reach))
            if len(a) > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def linked(parts: DataFrame) -> DataFrame:
        placed = parts.join(sigs, "node").select("cluster", "i", "j", "node", "sig")
        return placed.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "node").mapInArrow(link, "a long, b long")

    inside = linked(places.withColumn("i", F.col("own")).withColumn("j", F.col("own")))
    if once.where(F.col("n") > s.bucket_nodes).isEmpty():
        return components(near.unionByName(inside))
    inside = frames.materialize(near.unionByName(inside))
    return components(_across(frames.materialize(places.where("blocks > 1")), inside, linked, nodes.select("node", "bands"), s))


#: Bands by which a cluster may be cut one after the other; what is costly after them meets in blocks all the same.
CUTS = 2


def _across(places: DataFrame, inside: DataFrame, linked: Callable[[DataFrame], DataFrame], bands: DataFrame, s: Settings) -> DataFrame:
    """``inside`` and further links between blocks, enough to connect what ``linked`` would in whole clusters.

    ``places`` has ``cluster``, ``blocks``, ``own`` (block), ``node`` and ``size``; ``inside`` has links in single blocks.
    ``linked`` finds links in each (cluster, i, j) of rows that also have ``group``. First, the largest groups
    of all blocks of a cluster meet by one node each, at most about a block of them. Then two nodes of different
    groups include one outside the cluster's largest group: those are few as a rule, and only they go to every
    block. Where they are more than half of a cluster, its blocks meet in pairs. One group needs nothing more.
    A cluster whose rows would be repeated more than ``most_copies`` times is cut by ``bands`` first, if that repeats fewer.
    """

    def grouped(links: DataFrame) -> DataFrame:
        group = components(links)
        return frames.materialize(places.join(group, "node", "left").select(*places.columns, F.coalesce("component", "node").alias("group")))

    before = grouped(inside)
    sizes = places.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    each = F.greatest(F.lit(1), F.ceil(F.col("n") / F.col("blocks") / F.col("blocks")))
    # A window holds the groups of one block.
    rank = F.row_number().over(Window.partitionBy("cluster", "own").orderBy(F.desc("size"), "group"))
    first = (
        before.groupBy("cluster", "blocks", "own", "group").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("node"))
        .withColumn("rank", rank).join(sizes, "cluster").where(F.col("rank") <= each)
        .select("cluster", F.lit(-1).alias("i"), F.lit(-1).alias("j"), "node", "group")
    )
    links = frames.materialize(inside.unionByName(linked(first)))

    after = grouped(links).withColumn("band", F.lit(-1))
    pieces = [links]
    rest = F.col("n") - F.col("most")
    for level in range(CUTS + 1):
        groups = after.groupBy("cluster", "blocks", "group").agg(F.count(F.lit(1)).alias("rows"))
        whole = groups.groupBy("cluster", "blocks").agg(
            F.sum("rows").alias("n"), F.max("rows").alias("most"), F.max_by("group", F.struct("rows", "group")).alias("main")
        ).where("n > most")
        whole = frames.materialize(whole.withColumn("moves", F.col("blocks") * rest).drop("blocks"))
        if whole.isEmpty():
            break
        mixed = after.join(whole, "cluster")
        costly = mixed.where(F.col("moves") > s.most_copies * F.col("n"))
        if level == CUTS or costly.isEmpty():
            pieces.append(linked(_meetings(mixed, level > 0)))
            break
        after, replaced = _cut(costly, bands, level, s)
        pieces.append(frames.materialize(linked(_meetings(mixed.join(replaced, "cluster", "left_anti"), level > 0))))
    return frames.materialize(reduce(DataFrame.unionByName, pieces))


def _meetings(mixed: DataFrame, inside: bool) -> DataFrame:
    """``cluster``, ``i``, ``j``, ``node``, ``group``: where nodes of different groups in different blocks meet (also in one, if ``inside``)."""
    rest = F.col("n") - F.col("most")
    parts = F.ceil(F.col("blocks") * rest / F.col("n")).cast("int")
    part = F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")).cast("int")
    numbers = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    pair = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    others = numbers("blocks") if inside else F.array_remove(numbers("blocks"), F.col("own"))
    pairs = F.transform(others, lambda o: pair(F.least("own", o), F.greatest("own", o)))
    stays = F.transform(numbers("parts"), lambda j: pair(F.col("own"), j))
    goes = F.transform(numbers("blocks"), lambda i: pair(i, F.col("part")))
    at = F.when(2 * rest > F.col("n"), pairs).when(F.col("group") == F.col("main"), stays).otherwise(F.concat(stays, goes))
    return (
        mixed.withColumn("parts", parts).withColumn("part", part)
        .select("cluster", "node", "group", F.explode(at).alias("at")).select("cluster", "at.i", "at.j", "node", "group")
    )


def _cut(mixed: DataFrame, bands: DataFrame, level: int, s: Settings) -> tuple[DataFrame, DataFrame]:
    """Clusters cut by the bands after their last one (``band``), and which ``cluster``s that replaces.

    Only parts with several groups are kept. The same nodes often meet under many bands: they are one part, under the
    first of them. A cluster is replaced where its parts repeat fewer rows than it would (``moves``).
    """
    wide = mixed.join(bands, "node").select("cluster", "band", "node", "group", "size", F.posexplode("bands").alias("next", "value"))
    # A cluster that is itself a band's bucket is not cut by that band.
    further = wide.where("next > band AND value <> cluster")
    parts = frames.materialize(further.select(
        F.col("cluster").alias("parent"), F.xxhash64("cluster", "value").alias("cluster"), F.col("next").alias("band"), "node", "group", "size"
    ))
    same = ["n", "total", "a", "b", "x"]
    sums = parts.groupBy("parent", "cluster").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("total"), F.min("node").alias("a"), F.max("node").alias("b"),
        F.bit_xor(F.xxhash64("node")).alias("x"), F.min("group").alias("g"), F.max("group").alias("h"), F.min("band").alias("first"),
    ).where("g < h")
    once = frames.materialize(sums.groupBy("parent", *same).agg(F.min(F.struct("first", "cluster")).alias("least")))
    blocks = F.greatest(F.ceil(F.col("total") / s.block_shingles), F.ceil(F.col("n") / s.bucket_nodes)).cast("int")
    spent = once.groupBy(F.col("parent").alias("cluster")).agg(F.sum(F.col("n") * blocks).alias("spent"))
    replaced = mixed.select("cluster", "moves").distinct().join(spent, "cluster", "left").where("coalesce(spent, 0) < moves")
    replaced = frames.materialize(replaced.select("cluster"))
    chosen = once.join(replaced.select(F.col("cluster").alias("parent")), "parent", "left_semi").withColumn("blocks", blocks)
    chosen = chosen.groupBy(*same).agg(F.min("least").alias("least"), F.min("blocks").alias("blocks")).select("least.cluster", "blocks")
    own = F.pmod(F.xxhash64("node", F.lit(level + 2)), F.col("blocks")).cast("int")
    placed = parts.join(chosen, "cluster").select("cluster", "blocks", own.alias("own"), "node", "size", "group", "band")
    return frames.materialize(placed), replaced


class _Forest:
    """Union-find over places 0..n-1 with vectorised root look-up."""

    def __init__(self, labels: np.ndarray) -> None:
        self.label = labels.copy()

    def join(self, i: int, j: int) -> bool:
        p, q = self.label[i], self.label[j]
        if p == q:
            return False
        self.label[self.label == max(p, q)] = min(p, q)
        return True


def _exact_links(node: np.ndarray, sets: list[np.ndarray], sig: np.ndarray, group: np.ndarray, s: Settings) -> list[tuple[int, int]]:
    """Links that connect what is similar, between nodes of different ``group``s: a spanning forest of them."""
    order = np.argsort(node, kind="stable")
    forest, found = _Forest(np.unique(group, return_inverse=True)[1]), []
    size = np.array([len(z) for z in sets], dtype=np.int64)
    for place, x in enumerate(order):
        rest = order[:place]
        rest = rest[forest.label[rest] != forest.label[x]]
        # Sizes alone rule out what cannot reach the threshold.
        rest = rest[100 * np.minimum(size[rest], size[x]) >= s.percent * np.maximum(size[rest], size[x])]
        if len(rest):
            rest = rest[_close(sig, np.array([x]), rest, s.most_unequal)[0]]
        step = 1
        while len(rest):
            part, rest = rest[:step], rest[step:]
            step = min(step * 4, 256)
            flat = np.concatenate([sets[y] for y in part])
            at = np.minimum(np.searchsorted(sets[x], flat), size[x] - 1)
            same = np.add.reduceat((sets[x][at] == flat).astype(np.int64), np.cumsum(size[part]) - size[part])
            for y in part[100 * same >= s.percent * (size[part] + size[x] - same)]:
                if forest.join(int(x), int(y)):
                    found.append((int(node[x]), int(node[y])))
            rest = rest[forest.label[rest] != forest.label[x]]
    return found


def _verified(rows: DataFrame, s: Settings) -> DataFrame:
    """Exact links (a, b) inside each (cluster, i, j) of ``rows`` (cluster, i, j, node, group, sig, data)."""
    longs = s.longs

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for run in _runs(batches, 3):
            node, first = np.unique(run.column(3).to_numpy(), return_index=True)  # a repeated row counts once
            if len(node) < 2:
                continue
            sets: list[np.ndarray] = []
            for _, texts in T.buffers(run.column(6).combine_chunks().take(pa.array(first))):
                sets.extend(shingle_sets([t.lower() for t in texts], s.shingle))
            links = _exact_links(node, sets, _sig_matrix(run.column(5), longs)[first], run.column(4).to_numpy()[first], s)
            a.extend(p for p, _ in links)
            b.extend(q for _, q in links)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    parts = rows.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "node")
    return parts.select("cluster", "i", "j", "node", "group", "sig", "data").mapInArrow(check, "a long, b long")


def links(docs: DataFrame, nodes: DataFrame, key: str, text: str, settings: Settings = Settings()) -> DataFrame:
    """Exact links (a, b) between nodes, enough to connect every group."""
    s = settings
    clustered = frames.materialize(clusters(nodes, s).withColumnRenamed("component", "cluster"))
    wanted = nodes.join(clustered, "node").select("node", "cluster", "sig", "n_shingles", "id", "text_hash")
    sizes = wanted.groupBy("cluster").agg(F.sum("n_shingles").alias("total"), F.count(F.lit(1)).alias("n"))
    blocks = F.greatest(F.ceil(F.col("total") / s.block_shingles), F.ceil(F.col("n") / s.bucket_nodes)).cast("int")
    wanted = wanted.join(sizes.select("cluster", blocks.alias("blocks")), "cluster")
    source = docs.select(F.col(key).cast("long").alias("d_id"), F.xxhash64(text).alias("d_hash"), T.utf8(text).alias("data"))
    same = source["d_id"].eqNullSafe(wanted["id"]) & (source["d_hash"] == wanted["text_hash"])
    texts = source.join(wanted, same).select("cluster", "blocks", "node", "sig", F.col("n_shingles").alias("size"), "data")
    texts = texts.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    texts = frames.written(texts, "near-texts")

    inside = _verified(
        texts.select("cluster", F.col("own").alias("i"), F.col("own").alias("j"), "node", F.col("node").alias("group"), "sig", "data"), s
    )
    inside = frames.materialize(inside)
    large = texts.where("blocks > 1")
    if large.isEmpty():
        return inside
    places = frames.materialize(large.select("cluster", "blocks", "own", "node", "size").distinct())
    data = large.select("node", "sig", "data")

    def linked(parts: DataFrame) -> DataFrame:
        return _verified(parts.join(data, "node"), s)

    return _across(places, inside, linked, nodes.select("node", "bands"), s)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Per document: ``key``, ``n_shingles``, ``component_id`` and ``kept``; plus ``text_hash``.

    ``component_id`` is the smallest key reachable by links. A text without words is linked with nothing:
    its component is itself. Rows that repeat key and text give equal rows. Keys are expected to name one
    text; where the smallest key of two texts is the same, the texts are one group. Rows without a key take
    part; where no row of a group has one, ``component_id`` is null and all its rows count as kept.
    """
    s = settings
    sig = frames.written(signatures(docs, key, text, s), "signatures")
    filled = sig.where("n_shingles > 0")
    sets = ["s1", "s2", "n_shingles"]
    least_id = filled.groupBy(*sets).agg(F.min("id").alias("least"), F.min("text_hash").alias("any_hash"))
    # A set's node is its smallest key. Sets without a key, or whose smallest key names another set too, get a number of their own.
    first = F.row_number().over(Window.partitionBy("least", F.when(F.col("least").isNull(), F.col("s1"))).orderBy(*sets))
    node = F.when(F.col("least").isNotNull() & (F.col("first") == 1), F.col("least")).otherwise(
        F.lit(NO_ID) + F.col("s1").bitwiseAND(F.lit((1 << 61) - 1)))
    groups = frames.materialize(least_id.withColumn("first", first).withColumn("node", node).drop("first"))
    named = groups.select(*sets, F.col("least").alias("id"), "node")
    one = filled.where("id IS NOT NULL").join(named.where("id IS NOT NULL"), [*sets, "id"])
    none = filled.where("id IS NULL").join(
        groups.where("least IS NULL").select(*sets, F.col("any_hash").alias("text_hash"), "node"), [*sets, "text_hash"])
    columns = ["node", "n_shingles", "id", "text_hash", "bands", "sig"]
    nodes = frames.materialize(one.select(*columns).unionByName(none.select(*columns)).dropDuplicates(["node"]))
    shared_key = groups.where(f"node >= {NO_ID} AND least IS NOT NULL").select(F.col("node").alias("a"), F.col("least").alias("b"))
    found = components(links(docs, nodes, key, text, s).unionByName(shared_key))
    roots = groups.join(found, "node", "left").select(*sets, F.coalesce("component", "node").alias("component"))
    rows = sig.select("id", "text_hash", *sets, F.monotonically_increasing_id().alias("row"))
    least = F.when(F.col("n_shingles") == 0, F.col("id")).otherwise(F.when(F.col("component") < NO_ID, F.col("component")))
    joined = frames.hot_join(rows, roots, sets, ["id", "text_hash", "row"], "left")
    return joined.select(
        F.col("id").alias(key), "n_shingles", least.alias("component_id"), F.col("id").eqNullSafe(least).alias("kept"), "text_hash"
    )


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row of each group of near-duplicates: the one with the smallest key, with all its columns, whatever their names.

    Rows that repeat key and text are reduced to one. Rows without a key stay where no row of their group has one.
    Null texts and texts without words are copies of nothing. An empty table stays empty.
    """
    kept = near_duplicates(docs, key, text, settings).where("kept").select(F.col(key).alias("nd_key"), F.col("text_hash").alias("nd_hash")).distinct()
    # The row travels as one struct, so no column of it can clash.
    named = docs.select(F.struct("*").alias("doc"), F.col(key).alias("nd_own"), F.xxhash64(text).alias("nd_text"))
    same = named["nd_own"].eqNullSafe(kept["nd_key"]) & (named["nd_text"] == kept["nd_hash"])
    stays = named.join(kept, same, "left_semi")
    one = stays.where("nd_own IS NOT NULL").dropDuplicates(["nd_own", "nd_text"])
    return one.unionByName(stays.where("nd_own IS NULL")).select("doc.*")
