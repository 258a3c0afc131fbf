"""Perplexity from a class-based bigram model (Brown et al.) with exchange clustering.

    P(text) = product of P(class of word | class of word before) * P(word | its class)

Word counts cover all training texts. Classes are made in two steps. The ``top_words`` most frequent words, and
the endings of all others, are items; their bigrams over all texts form a table bounded by the number of items, on
which exchange clustering runs: item after item moves to the class that raises the likelihood most, until a pass
moves nothing. Then every further word of the head, the most frequent words whose number ``head_words`` bounds,
moves from its ending's class to the class that raises the likelihood most, given how often each class stands before
and after it in all texts: one grouped count over (word, side, class), solved where it is grouped. Class bigrams
are counted anew with these classes. Words beyond the head, seen or not, have the class of their ending.

The head is what occurs at least as often as a cut-off, found from counts of counts; no list of words is sorted. Scoring
looks the head up in a broadcast table and joins all other words, so the vocabulary may be of any size. Words are
known by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import frames, text as T

#: Stands for the end of a text, which also is what comes before its first word.
END = np.uint64(0xE5D0F7E87)


@dataclass(frozen=True)
class Settings:
    top_words: int = 767
    endings: int = 256
    classes: int = 96
    passes: int = 12
    head_words: int = 400_000
    add: float = 0.1
    #: Rarer words keep the class of their ending: their contexts say little.
    least_count: int = 3
    batch_tokens: int = 1_500_000

    @property
    def items(self) -> int:
        return self.top_words + self.endings + 1


@dataclass(frozen=True)
class ClassModel:
    settings: Settings
    tokens: int
    documents: int
    vocabulary: int
    counts: DataFrame = field(repr=False)  # word, n: all words of the training texts
    head: np.ndarray = field(repr=False)  # sorted hashes of the most frequent words
    head_counts: np.ndarray = field(repr=False)
    head_classes: np.ndarray = field(repr=False)
    ending_classes: np.ndarray = field(repr=False)
    moves: np.ndarray = field(repr=False)  # log10 P(class | class before)
    mass: np.ndarray = field(repr=False)  # log10 of what divides a word's smoothed count in its class
    clustered: int = 0  # words whose class comes from their own contexts

    @property
    def end_class(self) -> int:
        return len(self.moves) - 1


def tokens(texts: list[bytes], endings: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, ending numbers and bounds of texts, A-Z in lower case, without ends."""
    parts = [list(T.cut(texts[0].lower()))] if len(texts) == 1 else None
    buffers = parts[0] if parts else [b"\n".join(texts).lower()]
    hashes, ends_of, first = [], [], []
    for data in buffers:
        h, starts, ends = T.hash_buffer(data)
        a = np.frombuffer(data + b"\n\n\n", dtype=np.uint8).astype(np.uint32)
        last = np.zeros(len(h), dtype=np.uint32)
        for k in range(1, 4):
            place = ends - k
            last = last * np.uint32(0x01000193) + np.where(place >= starts, a[np.maximum(place, 0)], np.uint32(32))
        last ^= last >> np.uint32(13)
        last *= np.uint32(0x5BD1E995)
        last ^= last >> np.uint32(15)
        hashes.append(h)
        ends_of.append((last % np.uint32(endings)).astype(np.int64))
        first.append(starts)
    if parts:
        n = sum(map(len, hashes))
        return np.concatenate(hashes), np.concatenate(ends_of), np.array([0, n])
    lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    return hashes[0], ends_of[0], np.searchsorted(first[0], np.concatenate(([0], np.cumsum(lengths))))


def _find(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each value in a sorted table, and whether it is there."""
    if not len(table):
        return np.zeros(len(values), dtype=np.int64), np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return at, table[at] == values


def _items(hashes: np.ndarray, endings: np.ndarray, top: np.ndarray, s: Settings) -> np.ndarray:
    at, there = _find(top, hashes)
    return np.where(there, at, s.top_words + endings)


def _with_ends(values: np.ndarray, bounds: np.ndarray, end) -> np.ndarray:
    """``values`` with ``end`` after each text."""
    return np.insert(values, bounds[1:], end)


def _slim(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.coalesce(T.utf8(text), F.lit(b"")).alias("data"))


def count_words(docs: DataFrame, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``word`` (hash), ``ending`` and ``n`` over all texts; sums are combined before and after the shuffle."""
    s = settings

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_h, held_e, held = [], [], 0

        def flush() -> pa.RecordBatch:
            h, first, n = np.unique(np.concatenate(held_h), return_index=True, return_counts=True)
            e = np.concatenate(held_e)[first]
            held_h.clear(), held_e.clear()
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(e.astype(np.int32)), pa.array(n)], names=["word", "ending", "n"])

        for batch in batches:
            for _, texts in T.buffers(batch.column(0)):
                h, e, _ = tokens(texts, s.endings)
                held_h.append(h), held_e.append(e)
                held += len(h)
                if held >= s.batch_tokens:
                    yield flush()
                    held = 0
        if held:
            yield flush()

    rows = _slim(docs, text).mapInArrow(work, "word long, ending int, n long")
    return rows.groupBy("word", "ending").agg(F.sum("n").alias("n"))


def head_words(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash (sorted), ending and count of all words that occur at least as often as a cut-off; at most ``most`` words.

    The cut-off is the lowest that keeps to the bound. Counts are grouped by their first nine binary digits, so
    counts below 512 are told apart exactly and larger ones to 1 in 256; that is a few thousand groups, whatever the vocabulary.
    """
    least = F.expr("shiftleft(shiftright(n, greatest(length(bin(n)) - 9, 0)), greatest(length(bin(n)) - 9, 0))")
    groups = sorted(((r.least, r.words) for r in counts.groupBy(least.alias("least")).agg(F.count(F.lit(1)).alias("words")).collect()), reverse=True)
    cut, total = None, 0
    for low, words in groups:
        total += words
        if total > most:
            break
        cut = low
    kept = counts.where(F.col("n") >= cut) if cut is not None else counts.limit(0)
    got = kept.select("word", "ending", "n").toArrow()
    words = got.column("word").to_numpy().view(np.uint64)
    order = np.argsort(words)
    return words[order], got.column("ending").to_numpy()[order].astype(np.int64), got.column("n").to_numpy()[order]


def _sequences(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Word hashes, endings and bounds of consecutive texts."""
    for batch in batches:
        for _, texts in T.buffers(batch.column(0)):
            yield tokens(texts, s.endings)


def _matrix(docs: DataFrame, text: str, size: int, end: int, s: Settings, of: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Bigrams, over all texts, of the numbers below ``size`` that ``of`` gives words: a square matrix."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, dtype=np.int64)
        for h, e, bounds in _sequences(batches, s):
            seq = np.concatenate(([end], _with_ends(of(h, e), bounds, end)))
            code, n = np.unique(seq[:-1] * size + seq[1:], return_counts=True)
            total[code] += n
        code = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(code.astype(np.int32)), pa.array(total[code])], names=["code", "n"])

    rows = _slim(docs, text).mapInArrow(work, "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))
    got = rows.toArrow()  # at most size^2 rows of 12 bytes
    matrix = np.zeros(size * size, dtype=np.int64)
    matrix[got.column("code").to_numpy()] = got.column("n").to_numpy()
    return matrix.reshape(size, size)


def count_bigrams(docs: DataFrame, top: np.ndarray, text: str = "text", settings: Settings = Settings()) -> np.ndarray:
    """Item bigrams over all texts: a square matrix whose size is the number of items."""
    s = settings
    return _matrix(docs, text, s.items, s.items - 1, s, lambda h, e: _items(h, e, top, s))


def _class_of(hashes: np.ndarray, endings: np.ndarray, head: np.ndarray, head_classes: np.ndarray, ending_classes: np.ndarray) -> np.ndarray:
    at, there = _find(head, hashes)
    return np.where(there, head_classes[at] if len(head) else 0, ending_classes[endings])


def best_classes(word: np.ndarray, side: np.ndarray, context: np.ndarray, n: np.ndarray, bigrams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words (sorted runs of ``word``) and the class, other than the last, whose likelihood gains most by them.

    A row says how often class ``context`` stands before (side 0) or after (1) a word. A word in class k adds
    its counts to row and column k of the class bigrams, and to the sums that divide them.
    """
    table = bigrams.astype(np.float64)
    both = np.stack((table, table.T))  # [side, context, k]
    first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
    gain = np.zeros((len(first), len(table)))
    owner = np.repeat(np.arange(len(first)), np.diff(np.concatenate((first, [len(word)]))))
    for at in range(0, len(word), 1 << 14):
        part = slice(at, at + (1 << 14))
        now = both[side[part], context[part]]
        np.add.at(gain, owner[part], _g(now + n[part, None]) - _g(now))
    before = np.bincount(owner, np.where(side == 0, n, 0), len(first))[:, None]
    after = np.bincount(owner, np.where(side == 1, n, 0), len(first))[:, None]
    into, out = table.sum(axis=0)[None, :], table.sum(axis=1)[None, :]
    gain -= _g(into + before) - _g(into) + _g(out + after) - _g(out)
    gain[:, -1] = -np.inf
    return word[first], gain.argmax(axis=1)


def assign_classes(
    docs: DataFrame, head: np.ndarray, wanted: np.ndarray, head_classes: np.ndarray, ending_classes: np.ndarray, bigrams: np.ndarray,
    text: str, s: Settings,
) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``head`` and best classes of the ``wanted`` words, from their contexts in all texts."""
    size, end = len(bigrams), len(bigrams) - 1

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tokens_held = [], 0

        def flush() -> pa.RecordBatch:
            code, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            word, rest = np.divmod(code, 2 * size)
            return pa.RecordBatch.from_arrays([pa.array(word.astype(np.int32)), pa.array(rest.astype(np.int32)), pa.array(n)], names=["word", "slot", "n"])

        for h, e, bounds in _sequences(batches, s):
            seq = np.concatenate(([end], _with_ends(_class_of(h, e, head, head_classes, ending_classes), bounds, end)))
            at, there = _find(head, h)
            there &= wanted[at] if len(head) else False
            # Place of a word in the sequence: one end before all, and one after each text before its own.
            place = 1 + np.arange(len(h)) + np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            words, place = at[there] * (2 * size), place[there]
            held += [words + seq[place - 1], words + size + seq[place + 1]]
            tokens_held += len(words)
            if tokens_held >= s.batch_tokens:
                yield flush()
                tokens_held = 0
        if held:
            yield flush()

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: np.ndarray | None = None

        def chosen(rows: np.ndarray) -> pa.RecordBatch:
            found, best = best_classes(rows[:, 0], rows[:, 1] // size, rows[:, 1] % size, rows[:, 2], bigrams)
            return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(best.astype(np.int32))], names=["word", "class"])

        for batch in batches:
            now = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(3)], axis=1)
            rest = now if rest is None else np.concatenate((rest, now))
            # The last word may go on in the next batch.
            end_ = int(np.searchsorted(rest[:, 0], rest[-1, 0])) if len(rest) else 0
            if end_:
                yield chosen(rest[:end_])
                rest = rest[end_:]
        if rest is not None and len(rest):
            yield chosen(rest)

    counted = _slim(docs, text).mapInArrow(contexts, "word int, slot int, n long").groupBy("word", "slot").agg(F.sum("n").alias("n"))
    grouped = counted.repartition("word").sortWithinPartitions("word", "slot")
    got = grouped.mapInArrow(choose, "word int, class int").toArrow()  # at most one row for each word of the head
    return got.column("word").to_numpy().astype(np.int64), got.column("class").to_numpy().astype(np.int64)


def _g(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(bigrams: np.ndarray, classes: int, passes: int) -> np.ndarray:
    """Class of each item. The last item (the end of texts) keeps a class of its own, the last one.

    A move changes the likelihood by terms of one row and one column of the class bigram table, so all
    classes are tried at once for an item.
    """
    size = len(bigrams)
    b = bigrams.astype(np.float64)
    weight = b.sum(axis=0) + b.sum(axis=1)
    order = np.argsort(-weight[:-1], kind="stable")
    of = np.zeros(size, dtype=np.int64)
    of[order] = np.arange(size - 1) % (classes - 1)
    of[-1] = classes - 1
    hot = np.zeros((size, classes))
    hot[np.arange(size), of] = 1
    n = hot.T @ b @ hot
    right, left = b @ hot, b.T @ hot  # item to class after it, item to class before it
    for _ in range(passes):
        moved = 0
        for i in order:
            if not weight[i]:
                continue
            a, own = of[i], b[i, i]
            r, l = right[i].copy(), left[i].copy()
            r[a] -= own
            l[a] -= own
            # Take the item out of its class.
            n[a, :] -= r
            n[:, a] -= l
            n[a, a] -= own
            # Wherever it goes, the other classes get their steps into and out of it back.
            out, into = n.sum(axis=1) + l, n.sum(axis=0) + r
            gain = (_g(n + r[None, :]) - _g(n)).sum(axis=1) + (_g(n + l[:, None]) - _g(n)).sum(axis=0)
            d = np.diag(n)
            gain += _g(d + r + l + own) - _g(d + r) - _g(d + l) + _g(d)
            gain -= _g(out + r.sum() + own) - _g(out) + _g(into + l.sum() + own) - _g(into)
            gain[classes - 1] = -np.inf
            best = int(np.argmax(gain))
            if gain[best] <= gain[a] + 1e-9:
                best = a
            n[best, :] += r
            n[:, best] += l
            n[best, best] += own
            if best != a:
                moved += 1
                of[i] = best
                right[:, a] -= b[:, i]
                right[:, best] += b[:, i]
                left[:, a] -= b[i, :]
                left[:, best] += b[i, :]
        if not moved:
            break
    return of


def fit(docs: DataFrame, text: str = "text", settings: Settings = Settings()) -> ClassModel:
    """Count, cluster and smooth over all rows of ``docs``. A null text is empty: its only token is the end."""
    s = settings
    counts = frames.written(count_words(docs, text, s), "word-counts")
    n_docs = docs.count()
    sums = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, vocabulary = (sums.n or 0) + n_docs, sums.v + (n_docs > 0)
    # Bounded by ``head_words``: 20 bytes each.
    head, endings, freq = head_words(counts, s.head_words)
    order = np.lexsort((head, -freq))[: s.top_words]
    top = np.sort(head[order])
    bigrams = count_bigrams(docs, top, text, s)
    items = exchange(bigrams, s.classes, s.passes)
    ending_classes = items[s.top_words : s.top_words + s.endings]
    head_classes = items[_items(head, endings, top, s)]
    hot = np.zeros((s.items, s.classes))
    hot[np.arange(s.items), items] = 1
    n = hot.T @ bigrams @ hot
    # Every other word of the head to its best class; then the classes' bigrams as they now are.
    wanted = freq >= s.least_count
    wanted[order] = False
    if wanted.any():
        found, best = assign_classes(docs, head, wanted, head_classes, ending_classes, n, text, s)
        head_classes[found] = best
        n = _matrix(docs, text, s.classes, s.classes - 1, s, lambda h, e: _class_of(h, e, head, head_classes, ending_classes)).astype(np.float64)
    moves = np.log10((n + s.add) / (n.sum(axis=1, keepdims=True) + s.add * s.classes))
    # Distinct words of each class: those of the head, and all others by their ending.
    per_class = np.bincount(head_classes, minlength=s.classes).astype(np.float64)
    others = -np.bincount(endings, minlength=s.endings)
    for r in counts.groupBy("ending").agg(F.count(F.lit(1)).alias("v")).collect():  # at most ``endings`` rows
        others[r.ending] += r.v
    np.add.at(per_class, ending_classes, others)
    per_class[-1] += n_docs > 0
    mass = np.log10(n.sum(axis=0) + s.add * (per_class + 1))
    return ClassModel(
        s, int(total), n_docs, int(vocabulary), counts.select("word", "n"), head, freq, head_classes, ending_classes, moves, mass,
        int(wanted.sum()) + len(top),
    )


def score(docs: DataFrame, model: ClassModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``key``, ``n_tokens``, ``n_known``, ``base_score`` and ``score`` (log10 probabilities).

    ``base_score`` is the smoothed unigram model over the same counts. One row comes out for each row that
    goes in, repeated rows and null keys included.
    """
    s, end = model.settings, model.end_class
    head, moves, mass = model.head, model.moves, model.mass
    head_classes, ending_classes = model.head_classes, model.ending_classes
    head_counts, counts = model.head_counts, model.counts
    whole = float(np.log10(model.tokens + s.add * (model.vocabulary + 1)))
    end_log, end_known = float(np.log10(model.documents + s.add)), int(model.documents > 0)
    slim = docs.select(F.col(key).alias("lm_key"), F.coalesce(T.utf8(text), F.lit(b"")).alias("data"))

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for first, texts in T.buffers(batch.column(1)):
            h, e, bounds = tokens(texts, s.endings)
            n = np.diff(bounds) + 1
            c = np.concatenate(([end], _with_ends(_class_of(h, e, head, head_classes, ending_classes), bounds, end)))
            steps = moves[c[:-1], c[1:]] - mass[c[1:]]
            class_log = np.add.reduceat(steps, np.cumsum(n) - n)
            at, there = _find(head, h)
            logs = np.where(there, np.log10(np.where(there, head_counts[at], 0) + s.add) if len(head) else 0.0, 0.0)
            sums = np.concatenate(([0.0], np.cumsum(logs)))
            known = np.concatenate(([0], np.cumsum(there)))
            owner = np.repeat(np.arange(len(texts)), n - 1)[~there]
            rest = h[~there]
            # Other words, once for each text.
            order = np.lexsort((rest, owner))
            rest, owner = rest[order], owner[order]
            new = np.ones(len(rest), dtype=bool)
            new[1:] = (rest[1:] != rest[:-1]) | (owner[1:] != owner[:-1])
            places = np.flatnonzero(new)
            times = np.diff(np.concatenate((places, [len(rest)])))
            offsets = pa.array(np.searchsorted(owner[places], np.arange(len(texts) + 1)).astype(np.int32))
            longs = pa.ListArray.from_arrays(offsets, pa.array(rest[places].view(np.int64)))
            ints = pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, len(texts)), pa.array(n), pa.array(known[bounds[1:]] - known[bounds[:-1]] + end_known),
                 pa.array(sums[bounds[1:]] - sums[bounds[:-1]] + end_log), pa.array(class_log), longs, ints],
                names=["lm_key", "n_tokens", "head_known", "head_log", "class_log", "words", "times"],
            )

    kind = slim.schema["lm_key"].dataType.simpleString()
    rows = frames.written(
        T.map_batches(slim, work, f"lm_key {kind}, n_tokens long, head_known long, head_log double, class_log double, words array<long>, times array<int>")
        .withColumn("lm_row", F.monotonically_increasing_id()),
        "lm-rows",
    )
    tail = rows.select("lm_row", F.explode(F.arrays_zip("words", "times")).alias("t")).select(
        "lm_row", F.col("t.words").alias("word"), F.col("t.times").alias("times")
    )
    # No word here is among the most frequent ones, so no key is hot.
    seen = F.coalesce("n", F.lit(0))
    sums = (
        tail.join(counts, "word", "left").groupBy("lm_row")
        .agg(F.sum(F.col("times") * F.log10(seen + s.add)).alias("tail_log"), F.sum(F.when(seen > 0, F.col("times")).otherwise(0)).alias("tail_known"))
    )
    logs = F.col("head_log") + F.coalesce("tail_log", F.lit(0.0))
    return rows.drop("words", "times").join(sums, "lm_row", "left").select(
        F.col("lm_key").alias(key), "n_tokens", (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).cast("long").alias("n_known"),
        (logs - F.col("n_tokens") * F.lit(whole)).alias("base_score"), (logs + F.col("class_log")).alias("score"),
    )
