"""Token sequences packed by bin completion with branch and bound.

Texts become token ids, end with an end id, and are cut only where longer than a sequence. How the
pieces combine depends on their lengths alone, and there are at most as many lengths as a sequence
has tokens. So the search runs on the histogram of lengths: it fills sequences around the largest
length left, trying undominated fillings in order of waste, applies a filling as often as the counts
allow, and prunes whatever wastes too much to beat the incumbent, which starts as best-fit decreasing.
Where that misses the lower bound, the sequences with most waste are freed and completed anew, part by part.
The plan (patterns with multiplicities, bounded by the number of lengths) goes to the tasks, where a
piece finds its sequence and place from its rank among the pieces of its length.
"""

from __future__ import annotations

import json
import logging
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import frames, text as T

log = logging.getLogger(__name__)

CAPACITY = 2048
END_ID = 0
#: How byte-level BPE of this family cuts a text before merging (a fixed value of the vocabulary).
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CELL_ROWS = 200_000
#: tiktoken's pattern search overflows its stack on white space of about a million characters.
LONG_SPACE = 100_000
Plan = list[tuple[int, tuple[int, ...]]]


# ---------------------------------------------------------------- tokens


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte in byte-level vocabularies, inverted."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Ids that ``tokenizers`` gives with ``add_special_tokens=False``: none are added, but strings of added tokens are those tokens.

    ``tiktoken`` encodes the ordinary texts, which it does faster; the tokenizer itself does those with an added token or very
    long white space.
    """

    def __init__(self, path: str, split: str = SPLIT) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        special = {t["content"] for t in data.get("added_tokens", [])}
        self._added, self._full = sorted(special), Tokenizer.from_file(path)
        byte = _byte_alphabet()
        # Ids below the specials follow the order of merges, which is what ranks are.
        ranks = {bytes(byte[c] for c in token): i for token, i in data["model"]["vocab"].items() if token not in special}
        self._bpe = tiktoken.Encoding("local", pat_str=split, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        spaced = len(text) >= LONG_SPACE and any(m.end() - m.start() >= LONG_SPACE for m in re.finditer(r"\s+", text))
        if spaced or any(a in text for a in self._added):
            ids = self._full.encode(text, add_special_tokens=False).ids
        else:
            ids = self._bpe.encode_ordinary(text)
        return np.array(ids, dtype="<u4").tobytes()


def pieces(docs: DataFrame, tokenizer: str, keep: Sequence[str] = ("doc_id",), text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """``keep`` with ``piece`` (from 0), ``start``, ``length`` and ``ids`` (little-endian unsigned 32-bit).

    A null text is empty: its only token is the end id. A document longer than ``capacity`` is cut into
    pieces of ``capacity`` tokens, of which the first may be shorter. ``tokenizer`` is the path of the
    vocabulary on every executor.
    """
    slim = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("pk_text"))
    names = list(keep)
    end = np.array([END_ID], dtype="<u4").tobytes()

    def work(batch: pa.RecordBatch, encoder: Encoder) -> Iterator[pa.RecordBatch]:
        source: list[int] = []
        number, start, length, ids = [], [], [], []
        held = 0

        def flush() -> pa.RecordBatch:
            kept = [c.take(pa.array(source, pa.int64())) for c in batch.columns[:-1]]
            out = pa.RecordBatch.from_arrays(
                [*kept, pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int32()), pa.array(ids, pa.binary())],
                names=[*names, "piece", "start", "length", "ids"],
            )
            for column in (source, number, start, length, ids):
                column.clear()
            return out

        for row, value in enumerate(batch.column(batch.num_columns - 1)):
            data = encoder.encode(value.as_py()) + end
            n = len(data) // 4
            at, k = 0, 0
            while at < n:
                size = min(n, capacity) if at or n % capacity == 0 or n < capacity else n % capacity
                source.append(row)
                number.append(k)
                start.append(at)
                length.append(size)
                ids.append(data[4 * at : 4 * (at + size)])
                at, k = at + size, k + 1
            held += len(data)
            if held > 8 * T.BUFFER_BYTES:
                yield flush()
                held = 0
        if source:
            yield flush()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(tokenizer)
            yield from work(batch, encoder)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1]]
    return slim.mapInArrow(run, ", ".join([*fields, "piece int, start long, length int, ids binary"]))


# ---------------------------------------------------------------- plan


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Fewest sequences that any packing needs (the bound of Martello and Toth over all thresholds)."""
    sizes = np.arange(len(counts))
    number, total = np.cumsum(counts), np.cumsum(counts * sizes)
    best = -(-int(total[-1]) // capacity)
    half = capacity // 2
    for k in range(1, half + 1):
        large = int(number[-1] - number[capacity - k])
        middle = int(number[capacity - k] - number[half])
        room = middle * capacity - int(total[capacity - k] - total[half])
        small = int(total[half] - total[k - 1])
        best = max(best, large + middle + max(0, -(-(small - room) // capacity)))
    return best


def best_fit(counts: np.ndarray, capacity: int) -> Plan:
    """Best-fit decreasing on the histogram: bins with equal contents move together."""
    open_bins: dict[int, list[list]] = {}
    for size in range(capacity, 0, -1):
        left = int(counts[size])
        while left:
            rooms = [r for r in open_bins if r >= size]
            if rooms:
                room = min(rooms)
                group = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
                used = min(left, group[0])
                if used < group[0]:
                    open_bins.setdefault(room, []).append([group[0] - used, group[1]])
                open_bins.setdefault(room - size, []).append([used, (*group[1], size)])
                left -= used
            else:
                each = min(capacity // size, left)
                bins = left // each
                open_bins.setdefault(capacity - each * size, []).append([bins, (size,) * each])
                left -= bins * each
    return [(n, items) for groups in open_bins.values() for n, items in groups]


def fillings(counts: np.ndarray, gap: int, width: int, nodes: int) -> list[tuple[int, ...]]:
    """Up to ``width`` undominated fillings of ``gap``, least waste first, found within ``nodes`` steps.

    A filling is dominated when an item left over fits into its waste, or can take the place of one or
    of two of its items: the other filling leaves smaller items for later.
    """
    sizes = [int(x) for x in np.flatnonzero(counts[: gap + 1])[::-1]]
    if not sizes:
        return [()]
    found: list[tuple[int, tuple[int, ...]]] = []
    have = {x: int(counts[x]) for x in sizes}
    upto = np.cumsum(counts[: gap + 1] > 0).tolist()
    steps = 0
    chosen: list[int] = []
    used: dict[int, int] = dict.fromkeys(sizes, 0)

    def dominated(waste: int) -> bool:
        mine = set(chosen)
        gone = [x for x in mine if used[x] >= have[x]]

        def spare(low: int, high: int) -> bool:
            n = upto[high] - upto[low - 1]
            return n > len(gone) or n > sum(low <= x <= high for x in gone)

        if waste and (spare(1, waste) or any(spare(x + 1, x + waste) for x in mine)):
            return True
        return any(spare(a + b, a + b + waste) for i, a in enumerate(chosen) for b in chosen[i + 1 :]) if len(chosen) <= 8 else False

    def dive(first: int, room: int) -> bool:
        nonlocal steps
        steps += 1
        extended = False
        for k in range(first, len(sizes)):
            x = sizes[k]
            if x > room or used[x] >= have[x]:
                continue
            extended = True
            chosen.append(x)
            used[x] += 1
            stop = dive(k, room - x)
            used[x] -= 1
            chosen.pop()
            if stop:
                return True
            if steps > nodes:
                return bool(found)
        if not extended and not dominated(room):
            found.append((room, tuple(chosen)))
            return len(found) >= width and any(w == 0 for w, _ in found)
        return False

    dive(0, gap)
    return [items for _, items in sorted(found, key=lambda f: (f[0], len(f[1]), [-x for x in f[1]]))[:width]]


def exact_fillings(counts: np.ndarray, gap: int, width: int) -> list[tuple[int, ...]]:
    """Up to ``width`` fillings of ``gap`` without waste, larger items first.

    The largest items are taken while more than three of them fit; the rest is one, two or three items, looked up in the
    histogram. An item that fills the gap alone dominates all else, two items dominate three.
    """
    base: list[int] = []
    left = counts
    sizes = np.flatnonzero(left[: gap + 1])
    while len(sizes) and gap > 3 * sizes[-1]:
        if left is counts:
            left = counts.copy()
        x = int(sizes[-1])
        take = min(int(left[x]), (gap - 1) // x - 2)
        left[x] -= take
        gap -= take * x
        base += [x] * take
        sizes = sizes[:-1] if not left[x] else sizes
        sizes = sizes[: np.searchsorted(sizes, gap, side="right")]
    if not gap:
        return [tuple(base)]
    if not len(sizes):
        return []
    if left[gap]:
        return [(*base, gap)]
    pairs = _pairs(left, gap, gap)
    if len(pairs):
        return [(*base, int(x), gap - int(x)) for x in pairs[:width]]
    found: list[tuple[int, ...]] = []
    for x in sizes[::-1]:
        x = int(x)
        if 3 * x < gap:
            break
        left[x] -= 1
        found += [(*base, x, int(y), gap - x - int(y)) for y in _pairs(left, gap - x, x)[: width - len(found)]]
        left[x] += 1
        if len(found) >= width:
            break
    return found


def _pairs(counts: np.ndarray, total: int, top: int) -> np.ndarray:
    """The larger items, at most ``top``, of all pairs that add up to ``total``, largest first."""
    low, high = (total + 1) // 2, min(total - 1, top)
    if high < low:
        return np.zeros(0, dtype=np.int64)
    both = (counts[low : high + 1] > 0) & (counts[total - high : total - low + 1][::-1] > 0)
    if 2 * low == total:
        both[0] = counts[low] > 1
    return (np.flatnonzero(both) + low)[::-1]


class Packing(NamedTuple):
    """A plan (how many sequences, the lengths in each), its sequences, the lower bound, and how the plan was found."""

    plan: Plan
    sequences: int
    bound: int
    found_by: str


def search(counts: np.ndarray, capacity: int, width: int = 2, nodes: int = 150, dives: int = 3, rounds: int | None = None) -> Packing:
    """Best fit, then completion, then completion of parts: each only where the one before misses the lower bound.

    Completion applies as many fillings as ``dives`` descents through all distinct lengths need, at every size. A round
    frees the sequences with most waste and some others and completes these few items anew; there are as many
    ``rounds`` as distinct lengths, unless given. The result never has more sequences than best fit.
    """
    plan = best_fit(counts, capacity)
    distinct = int((counts > 0).sum())
    best = Packing(plan, sum(n for n, _ in plan), lower_bound(counts, capacity), "best fit")
    if best.sequences > best.bound:
        plan = _descend(counts, capacity, best, width, nodes, max(2500, dives * width * distinct))
        if plan is not None:
            best = best._replace(plan=plan, sequences=sum(n for n, _ in plan), found_by="completion")
    if best.sequences > best.bound:
        plan = _repair(best, capacity, distinct if rounds is None else rounds)
        if plan is not None:
            best = best._replace(plan=plan, sequences=sum(n for n, _ in plan), found_by="completion of parts")
    return best


def complete(counts: np.ndarray, capacity: int) -> Plan:
    """The best plan found: (how many sequences, the lengths in each)."""
    return search(counts, capacity).plan


def _descend(counts: np.ndarray, capacity: int, start: Packing, width: int, nodes: int, limit: int) -> Plan | None:
    """A plan with fewer sequences than ``start``, by branch and bound within ``limit`` fillings; None if there is none."""
    best, bins, floor = None, start.sequences, start.bound
    total = int((counts * np.arange(len(counts))).sum())
    # Depth first over (counts left, plan so far, sequences and waste so far); the best branch is on top of the stack.
    stack: list[tuple[np.ndarray, tuple, int, int]] = [(counts.copy(), (), 0, 0)]
    seen = 0
    while stack and bins > floor and seen < limit:
        left, link, used, waste = stack.pop()
        if waste > (bins - 1) * capacity - total:
            continue
        some = np.flatnonzero(left)
        if not len(some):
            bins, best = used, []
            while link:
                best.append(link[0])
                link = link[1]
            continue
        lead = int(some[-1])
        left[lead] -= 1
        gap = capacity - lead
        options = exact_fillings(left, gap, width) or fillings(left, gap, width, nodes) or [best_filling(left, gap)]
        left[lead] += 1
        for items in reversed(options):
            seen += 1
            need = Counter((lead, *items))
            times = min(int(left[x]) // n for x, n in need.items())
            rest = left.copy()
            for x, n in need.items():
                rest[x] -= n * times
            lost = (capacity - lead - sum(items)) * times
            stack.append((rest, ((times, (lead, *items)), link), used + times, waste + lost))
    return best


def _repair(start: Packing, capacity: int, rounds: int, wasteful: int = 8, others: int = 8) -> Plan | None:
    """``start`` with fewer sequences, by completing few of them anew again and again; None if no round saves one.

    A round that saves none still counts where it gathers the waste in fewer sequences. The choice of sequences follows
    from the round's number, so equal histograms get equal plans.
    """
    plan: Counter = Counter()
    for n, items in start.plan:
        plan[tuple(sorted(items, reverse=True))] += n
    count, rng = start.sequences, np.random.default_rng(0)
    for _ in range(rounds):
        if count <= start.bound:
            break
        open_ = sorted((i for i in plan if sum(i) < capacity), key=lambda i: (sum(i), i))
        full = [i for i in plan if sum(i) == capacity]
        if not open_:
            break
        freed = Counter({open_[0]: 1})
        for pool, size in ((open_, wasteful), (full or open_, others)):
            for k in rng.integers(0, len(pool), size):
                if freed[pool[k]] < plan[pool[k]]:
                    freed[pool[k]] += 1
        part = np.zeros(capacity + 1, dtype=np.int64)
        for items, n in freed.items():
            np.add.at(part, list(items), n)
        number = sum(freed.values())
        # One more is allowed, so a new arrangement of as many sequences can come out.
        again = _descend(part, capacity, Packing([], number + 1, lower_bound(part, capacity), ""), 2, 60, 6 * number)
        if again is None:
            continue
        after: Counter = Counter()
        for n, items in again:
            after[tuple(sorted(items, reverse=True))] += n
        if (sum(after.values()), -_gathered(after, capacity)) <= (number, -_gathered(freed, capacity)):
            plan = plan - freed + after
            count += sum(after.values()) - number
    return [(n, items) for items, n in plan.items()] if count < start.sequences else None


def _gathered(part: Counter, capacity: int) -> int:
    """Larger where the same waste lies in fewer sequences."""
    return sum(n * (capacity - sum(items)) ** 2 for items, n in part.items())


def best_filling(counts: np.ndarray, gap: int) -> tuple[int, ...]:
    """Largest item that fits, again and again."""
    left, items = counts.copy(), []
    while gap and len(some := np.flatnonzero(left[: gap + 1])):
        x = int(some[-1])
        left[x] -= 1
        gap -= x
        items.append(x)
    return tuple(items)


def segments(plan: Plan) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, first sequence, pieces of this length in each, offset of the first of them)."""
    taken: Counter = Counter()
    sequence, out = 0, []
    for times, items in plan:
        offset = 0
        for size, each in sorted(Counter(items).items(), reverse=True):
            out.append((size, taken[size], sequence, each, offset))
            taken[size] += times * each
            offset += size * each
        sequence += times
    return sorted(out)


# ---------------------------------------------------------------- rows


def pack(rows: DataFrame, order: Sequence[str], capacity: int = CAPACITY, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``rows`` (with ``length`` from 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    ``order`` names columns that tell rows apart; rows equal in them may swap places. Rows should be
    narrow or stored: they are read twice and shuffle once, by length. An empty table stays empty.
    """
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():  # at most ``capacity`` rows
        counts[r.length] = r.n
    found = search(counts, capacity)
    log.info("%d sequences by %s, at least %d are needed", found.sequences, found.found_by, found.bound)
    by = segments(found.plan)
    seg_at = np.array([(s[0] << 40) + s[1] for s in by], dtype=np.int64)
    lo, base, each, offset = (np.array([s[k] for s in by], dtype=np.int64) for k in (1, 2, 3, 4))
    cells = max(1, -(-int(counts.max()) // cell_rows))
    salt = F.xxhash64(*order)
    ranks = frames.ranked(rows, "length", salt, list(order), cells, "pack_rank")

    def place(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rank = batch.column("pack_rank").to_numpy()
        length = batch.column("length").to_numpy().astype(np.int64)
        at = np.searchsorted(seg_at, (length << 40) + rank, side="right") - 1
        inside = rank - lo[at]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(base[at] + inside // each[at]), pa.array(offset[at] + inside % each[at] * length)],
            names=[*batch.schema.names, "sequence_id", "offset"],
        )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in ranks.schema.fields]
    return T.map_batches(ranks, place, ", ".join([*fields, "sequence_id long, offset long"])).drop("pack_rank")


def pack_documents(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """``key``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and ``offset`` of every piece.

    Ids are digested before anything is stored; rows with a null or repeated key are packed like others.
    """
    cut = pieces(docs.select(F.col(key).alias("pk_key"), text), tokenizer, ["pk_key"], text, capacity)
    narrow = cut.select("pk_key", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    packed = pack(frames.written(narrow, "pieces"), ["pk_key", "piece", "ids_crc32"], capacity)
    return packed.select(
        F.col("pk_key").alias(key), "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset"
    )
