"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is the bag of its byte n-grams inside words (with word edges), hashed into buckets. Each
bucket has an embedding; a text's vector is their average, and a linear softmax names the language.
Embeddings and softmax are trained together by stochastic gradient descent in numpy. As the model is
linear after the average, prediction needs one row of class scores per bucket, which is all that
tasks receive.

The fit uses a bounded sample: spans of at most ``span_bytes`` of about ``per_lang`` texts of each
language, texts and places chosen by hashes, all of them within ``sample_bytes`` on the driver. Every
language of the texts is learned, also one with a handful of texts: rare ones come up as often as
frequent ones. Predictions read whole texts. Probabilities are scaled by a temperature fitted on texts that training did not see, and a
prediction is rejected when its probability is below a threshold set on the same texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import text as T

ORDERS = (2, 3, 4, 5)
BUCKETS = 1 << 16


@dataclass(frozen=True)
class Settings:
    #: Texts of each language that are learned from, about so many, and the bytes that a text gives at most.
    per_lang: int = 200
    span_bytes: int = 1500
    #: Bound, in bytes, of the sample on the driver; many languages give shorter spans.
    sample_bytes: int = 32_000_000
    buckets: int = BUCKETS
    dim: int = 16
    epochs: int = 12
    #: Steps of training at least, however few texts there are.
    least_steps: int = 600
    rate: float = 20.0
    piece_bytes: int = 160
    calibration_share: float = 0.2

    def span(self, langs: int) -> int:
        """Bytes taken from a text. An n-gram costs four bytes, and a byte begins one of each order."""
        fits = self.sample_bytes // max(1, langs * self.per_lang * 4 * len(ORDERS))
        return max(self.piece_bytes, min(self.span_bytes, fits))

    #: At most this share of right predictions on the calibration texts may be rejected ...
    reject_share: float = 0.001
    #: ... and never one whose calibrated probability is at least this.
    reject_below: float = 0.5
    seed: int = 11


@dataclass(frozen=True)
class LanguageModel:
    langs: list[str]
    scores: np.ndarray = field(repr=False)  # buckets by languages
    bias: np.ndarray = field(repr=False)
    temperature: float = 1.0
    threshold: float = 0.0


def folded(data: bytes) -> bytes:
    """A-Z and the capital letters of Latin-1 in lower case."""
    a = np.frombuffer(data.lower(), dtype=np.uint8)
    if len(a) < 2 or 0xC3 not in data:
        return a.tobytes()
    a = a.copy()
    after = a[1:]
    after[(a[:-1] == 0xC3) & (after >= 0x80) & (after <= 0x9E) & (after != 0x97)] += 0x20
    return a.tobytes()


def grams(data: bytes, order: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the second byte, and buckets, of all n-grams that hold white space only at their ends."""
    a = np.frombuffer(folded(data), dtype=np.uint8)
    space = T._is_space()[a]
    n = len(a) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a = np.where(space, np.uint8(32), a).astype(np.uint32)
    h = np.full(n, order, dtype=np.uint32)
    ok = ~(space[:n] & space[order - 1 : order - 1 + n])
    for k in range(order):
        h = h * np.uint32(0x01000193) + a[k : k + n] * np.uint32(0x9E3779B1)
        if 0 < k < order - 1:
            ok &= ~space[k : k + n]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    places = np.flatnonzero(ok)
    return places + 1, (h[places] % np.uint32(buckets)).astype(np.int64)


def _bag(data: bytes, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and how often each occurs."""
    total = np.zeros(buckets, dtype=np.int64)
    data = b"\n" + folded(data) + b"\n"
    # Parts overlap by what an n-gram needs, so each starts in one part and a word may be of any length.
    for at in range(0, len(data), T.BUFFER_BYTES):
        for order in ORDERS:
            total += np.bincount(grams(data[at : at + T.BUFFER_BYTES + order - 1], order, buckets)[1], minlength=buckets)
    ids = np.flatnonzero(total)
    return ids.astype(np.uint32), total[ids].astype(np.uint32)


def _sample(docs: DataFrame, key: str, text: str, lang: str, s: Settings) -> tuple[list[str], DataFrame]:
    """All languages of the texts, and about ``per_lang`` texts of each; rare languages with all of theirs."""
    named = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = named.groupBy(lang).agg(F.count(F.lit(1)).alias("n")).collect()  # one row per language
    # Hash below a share of its range: a fixed choice. A table of shares, so any number of languages is one join.
    shares = [(r[lang], min(1.0, s.per_lang / r.n)) for r in counts]
    if not shares:
        return [], named.limit(0)
    place = F.pmod(F.xxhash64(F.lit(s.seed), F.col(key)), F.lit(1 << 30)) / float(1 << 30)
    table = docs.sparkSession.createDataFrame(shares, "sample_lang string, sample_share double")
    met = named.join(F.broadcast(table), F.col(lang) == F.col("sample_lang")).where(place < F.col("sample_share"))
    return sorted(r[lang] for r in counts), met


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", settings: Settings = Settings()) -> LanguageModel:
    """Train on ``docs``; rows with a null text or language are left out. No rows give a model without languages."""
    s = settings
    langs, chosen = _sample(docs, key, text, lang, s)
    if not langs:
        return LanguageModel([], np.zeros((s.buckets, 0), np.float32), np.zeros(0))
    span, kind = s.span(len(langs)), _id_type(s)

    def bags(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        names, order = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        out: list[list] = [[], [], [], [], []]
        for name, value, place in zip(names, batch.column(1), order):
            data = value.as_py()
            # A span of the text, and a short piece of it so that short texts are learned too.
            start = place % max(1, len(data))
            piece = data[start : start + s.piece_bytes].split(b" ", 1)[-1].rsplit(b" ", 1)[0]
            begin = (place // 7) % max(1, len(data) - span)
            for whole, part in ((True, data[begin : begin + span]), (False, piece)) if span > s.piece_bytes else ((True, data[begin : begin + span]),):
                ids, counts = _bag(part, s.buckets)
                if len(ids):
                    counts = np.minimum(counts, 0xFFFF).astype(np.uint16)
                    for column, v in zip(out, (name, whole, place, ids.astype(kind).tobytes(), counts.tobytes())):
                        column.append(v)
        kinds = (pa.string(), pa.bool_(), pa.int64(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["lang", "whole", "place", "ids", "counts"])

    slim = chosen.select(F.col(lang).cast("string").alias("lang"), T.utf8(text).alias("data"), F.shiftrightunsigned(F.xxhash64(F.lit(s.seed + 1), F.col(key), F.col(text)), 1).alias("place"))
    # Bounded by ``sample_bytes``: bags of bounded spans of about ``per_lang`` texts of each language.
    rows = T.map_batches(slim, bags, "lang string, whole boolean, place long, ids binary, counts binary").collect()
    rows.sort(key=lambda r: (r.place, r.lang, not r.whole, r.ids))
    model = _train(rows, langs, s)
    del rows
    return model


def _id_type(s: Settings) -> type:
    return np.uint16 if s.buckets <= 1 << 16 else np.uint32


def _balanced(y: np.ndarray, rows: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """``rows`` in random order, those of rarer languages as often as those of the most frequent one, in turn."""
    groups = [rng.permutation(rows[y[rows] == k]) for k in np.unique(y[rows])]
    most = max(map(len, groups))
    turns = np.stack([np.resize(g, most) for g in groups], axis=1)
    return rng.permuted(turns, axis=1).ravel()


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _train(rows: list, langs: list[str], s: Settings) -> LanguageModel:
    number = {name: k for k, name in enumerate(langs)}
    y = np.array([number[r.lang] for r in rows], dtype=np.int64)
    held = np.array([(r.place % 1000) < 1000 * s.calibration_share for r in rows], dtype=bool)
    whole = np.array([r.whole for r in rows], dtype=bool)
    # Views of the collected bytes; a text's weights are made when it is used, so the sample is held once.
    ids = [np.frombuffer(r.ids, dtype=_id_type(s)) for r in rows]
    counts = [np.frombuffer(r.counts, dtype=np.uint16) for r in rows]

    def share(i: int) -> np.ndarray:
        return (counts[i] / counts[i].sum()).astype(np.float32)

    rng = np.random.default_rng(s.seed)
    table = rng.normal(0, 0.05, (s.buckets, s.dim)).astype(np.float32)
    weights = rng.normal(0, 0.05, (s.dim, len(langs))).astype(np.float32)
    bias = np.zeros(len(langs), dtype=np.float32)
    train = np.flatnonzero(~held) if (~held).any() else np.arange(len(y))
    size, done = 16, 0
    epoch = -(-len(_balanced(y, train, np.random.default_rng(0))) // size)
    epochs = max(s.epochs, -(-s.least_steps // epoch))
    steps = epochs * epoch
    for _ in range(epochs):
        order = _balanced(y, train, rng)
        for at in range(0, len(order), size):
            rate = s.rate * (1 - done / steps)
            done += 1
            batch = order[at : at + size]
            vectors = np.stack([share(i) @ table[ids[i]] for i in batch])
            error = _softmax(vectors @ weights + bias)
            error[np.arange(len(batch)), y[batch]] -= 1
            error /= len(batch)
            back = error @ weights.T
            weights -= rate * 0.1 * (vectors.T @ error)
            bias -= rate * 0.01 * error.sum(axis=0)
            for j, i in enumerate(batch):
                table[ids[i]] -= rate * share(i)[:, None] * back[j]
    scores = (table @ weights).astype(np.float32)
    # Calibration on texts that training did not see (on all, should a tiny sample hold none).
    test = np.flatnonzero(held) if held.any() else np.arange(len(y))
    logits = np.stack([share(i) @ scores[ids[i]] for i in test]) + bias
    loss = {t: -np.log(_softmax(logits / t)[np.arange(len(test)), y[test]] + 1e-12).mean() for t in np.geomspace(0.05, 20, 80)}
    temperature = float(min(loss, key=loss.get))
    best = _softmax(logits / temperature)
    right = (best.argmax(axis=1) == y[test]) & whole[test]
    threshold = min(float(np.quantile(best.max(axis=1)[right], s.reject_share)) if right.any() else 0.0, s.reject_below)
    return LanguageModel(langs, scores, bias.astype(np.float64), temperature, threshold)


def _sums(texts: list[bytes], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Summed class scores and number of n-grams of each text."""
    if len(texts) == 1 and len(texts[0]) > T.BUFFER_BYTES:
        ids, counts = _bag(texts[0], len(table))
        return (counts.astype(np.float64) @ table[ids])[None, :], np.array([counts.sum()], dtype=np.int64)
    data = b"\n" + b"\n".join(texts) + b"\n"
    starts = np.cumsum([1] + [len(t) + 1 for t in texts])
    total = np.zeros((len(texts), table.shape[1]))
    count = np.zeros(len(texts), dtype=np.int64)
    for order in ORDERS:
        places, ids = grams(data, order, len(table))
        bounds = np.searchsorted(places, starts)
        n = np.diff(bounds)
        values = np.concatenate((table[ids], np.zeros((1, table.shape[1]), table.dtype)))
        summed = np.add.reduceat(values, bounds[:-1], axis=0)
        total += np.where(n[:, None] > 0, summed, 0)
        count += n
    return total, count


def identify(docs: DataFrame, model: LanguageModel, keep=("doc_id",), text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``lang_pred``, ``score`` (calibrated probability) and ``accepted``.

    A null text, or one without a letter, gives ``und`` with score 0 and is rejected; so does every text
    where the model knows no language. Only the text is read. One row comes out for each row that goes in.
    """
    slim = docs.select(
        *keep, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("li_letters"), T.utf8(text).alias("li_text")
    )
    names = list(keep)
    langs = np.array(model.langs, dtype=object)
    table, bias, heat, limit = model.scores, model.bias, model.temperature, model.threshold
    size = max(1 << 16, T.BUFFER_BYTES * 4 // max(4, len(langs)))

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        letters = np.array(batch.column(len(names)).to_pylist(), dtype=bool)
        for first, texts in T.buffers(batch.column(len(names) + 1), size):
            known = letters[first : first + len(texts)]
            if len(langs):
                total, count = _sums(texts, table)
                chance = _softmax((total / np.maximum(count, 1)[:, None] + bias) / heat)
                best, top = chance.argmax(axis=1), chance.max(axis=1)
                pred = np.where(known, langs[best], "und")
                score = np.where(known, np.clip(top, 0, 1), 0.0)
            else:
                pred, score, known = np.full(len(texts), "und", dtype=object), np.zeros(len(texts)), known & False
            kept = [batch.column(i).slice(first, len(texts)) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(pred.tolist(), pa.string()), pa.array(score), pa.array(known & (score >= limit))],
                names=[*names, "lang_pred", "score", "accepted"],
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[: len(names)]]
    return T.map_batches(slim, work, ", ".join([*fields, "lang_pred string", "score double", "accepted boolean"]))


def accept(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, with all their columns."""
    whole = docs.select(F.struct("*").alias("doc"), F.col(text).alias("doc_text"))
    return identify(whole, model, ["doc"], "doc_text").where("accepted").select("doc.*")
