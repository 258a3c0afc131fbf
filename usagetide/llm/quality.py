"""A quality score from document statistics: random Fourier features, ridge, isotonic calibration.

The statistics come from the measurements of the rule ledger. Random Fourier features approximate a
Gaussian kernel over the standardised statistics. Every partition of labelled rows adds up its part of
the normal equations, one for each fold of the rows; the parts are summed by fold and matrix row, so neither
one task nor the driver sees more than these matrices. Scores are calibrated by isotonic regression over a
fixed number of score bins: every labelled row is scored by the fit of the other folds, so each takes part
in the final fit and in its calibration, and none calibrates a fit that has seen it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import frames, rules, text as T

#: Statistics as expressions over the ledger's measurements; defined for texts without words too.
STATISTICS = (
    "ln(1 + n_words)",
    "word_chars / greatest(n_words, 1)",
    "ln(1 + 10 * n_symbols / greatest(n_words, 1))",
    "ln(1 + 10 * n_bangs / greatest(n_words, 1))",
    "n_upper / greatest(n_upper + n_lower, 1)",
    "n_dup_lines / greatest(n_lines, 1)",
    "n_repeat_words / greatest(n_words, 1)",
    "ln(1 + n_words / greatest(n_lines, 1))",
)


@dataclass(frozen=True)
class Settings:
    features: int = 256
    width: float = 1.5
    ridge: float = 1e-4
    bins: int = 1024
    folds: int = 4  # every fold is scored for calibration by the fit of the others
    partition_rows: int = 200_000
    seed: int = 5


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    spread: np.ndarray
    directions: np.ndarray = field(repr=False)
    phases: np.ndarray = field(repr=False)
    weights: np.ndarray | None = field(repr=False)
    knots: np.ndarray = field(repr=False)
    levels: np.ndarray = field(repr=False)

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.cos(((x - self.mean) / self.spread) @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.concatenate((z, np.ones((len(z), 1))), axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.zeros(len(x)) if self.weights is None else self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.levels), 0.0, 1.0)


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``stats`` (array of doubles), one row per document; a null text counts as empty."""
    book = rules.ledger(docs.select(F.col(key).alias("qs_key"), text), ["qs_key"], text)
    values = [F.expr(f"CAST({e} AS DOUBLE)") for e in STATISTICS]
    return book.select(F.col("qs_key").alias(key), F.array(*values).alias("stats"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def isotonic(ones: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Non-decreasing fit to ``ones / rows`` by pooling adjacent violators; ``rows`` are positive."""
    blocks: list[list[float]] = []
    for one, n in zip(ones, rows):
        blocks.append([float(one), float(n), 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    return np.concatenate([np.full(int(k), one / n) for one, n, k in blocks])


def fit(labelled: DataFrame, settings: Settings = Settings()) -> QualityModel:
    """Train on rows (``key``, ``stats``, ``label`` 0 or 1). All labelled rows take part; none gives score 0.5 to all."""
    s, d = settings, len(STATISTICS)
    rng = np.random.default_rng(s.seed)
    directions = rng.normal(0, 1 / (s.width * np.sqrt(d)), (d, s.features)) * np.sqrt(2)
    phases = rng.uniform(0, 2 * np.pi, s.features)
    flat = [F.col("stats")[k] for k in range(d)]
    sums = labelled.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"m{k}") for k, c in enumerate(flat)], *[F.stddev_pop(c).alias(f"s{k}") for k, c in enumerate(flat)],
    ).first()
    if not sums.n:
        return QualityModel(np.zeros(d), np.ones(d), directions, phases, None, np.array([0.0]), np.array([0.5]))
    mean = np.array([sums[f"m{k}"] for k in range(d)])
    spread = np.array([max(sums[f"s{k}"], 1e-6) for k in range(d)])
    model = QualityModel(mean, spread, directions, phases, None, np.array([0.0]), np.array([0.5]))
    # One number per row, known before and after a retry, is its fold.
    fold = F.pmod(F.xxhash64(F.lit(s.seed), "stats", "key"), F.lit(s.folds)).cast("int")
    rows = labelled.select("stats", "label", fold.alias("fold"))
    size = s.features + 1

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((s.folds, size, size + 1))
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                piece = batch.slice(at, 4096)
                if piece.num_rows:
                    z = model.features(_matrix(piece.column(0), d))
                    y = piece.column(1).to_numpy(zero_copy_only=False).astype(float)
                    own = piece.column(2).to_numpy()
                    for k in np.unique(own):
                        total[k] += z[own == k].T @ np.column_stack((z[own == k], y[own == k]))
        flat_rows = total.reshape(-1, size + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(flat_rows), dtype=np.int32)), pa.array([row.tobytes() for row in flat_rows], pa.binary())], names=["i", "row"]
        )

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v.as_py()) for v in table.column("row"))
        return pa.table({"i": table.column("i").slice(0, 1), "row": pa.array([total.tobytes()], pa.binary())})

    def solve(matrix: np.ndarray) -> np.ndarray:
        seen = max(matrix[-1, -2], 1.0)  # the last feature is 1, so its square counts rows
        return np.linalg.solve(matrix[:, :-1] + s.ridge * seen * np.eye(size), matrix[:, -1])

    parts = max(1, -(-sums.n // s.partition_rows))
    partial = rows.repartition(parts).mapInArrow(normal, "i int, row binary")
    summed = partial.groupBy("i").applyInArrow(add, "i int, row binary").collect()  # ``folds`` * (``features`` + 1) rows
    matrices = np.zeros((s.folds * size, size + 1))
    for r in summed:
        matrices[r.i] = np.frombuffer(r.row)
    matrices = matrices.reshape(s.folds, size, size + 1)
    whole = matrices.sum(axis=0)
    weights = solve(whole)
    left_out = np.array([solve(whole - m) for m in matrices])

    def binned(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = batch.column(2).to_numpy()
        raw = np.empty(batch.num_rows)
        for at in range(0, batch.num_rows, 4096):
            z = model.features(_matrix(batch.slice(at, 4096).column(0), d))
            raw[at : at + 4096] = (z * left_out[own[at : at + 4096]]).sum(axis=1)
        place = np.clip(((raw + 0.5) / 2 * s.bins).astype(np.int64), 0, s.bins - 1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(place), batch.column(1).cast(pa.int64())], names=["bin", "label"])

    bins = (
        T.map_batches(rows, binned, "bin int, label long")
        .groupBy("bin").agg(F.sum("label").alias("ones"), F.count(F.lit(1)).alias("n")).orderBy("bin").collect()  # at most ``bins``
    )
    knots = (np.array([r.bin for r in bins]) + 0.5) / s.bins * 2 - 0.5
    levels = isotonic(np.array([r.ones for r in bins]), np.array([r.n for r in bins]))
    return QualityModel(mean, spread, directions, phases, weights, knots, levels)


def score(stats: DataFrame, model: QualityModel, key: str = "doc_id") -> DataFrame:
    """``key`` and ``score`` (0 to 1), one row for each row of ``stats``."""
    d = len(STATISTICS)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at in range(0, batch.num_rows, 4096):
            piece = batch.slice(at, 4096)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(model.score(_matrix(piece.column(1), d)))], names=[key, "score"]
            )

    kind = stats.schema[key].dataType.simpleString()
    return T.map_batches(stats.select(key, "stats"), work, f"`{key}` {kind}, score double")


def train_and_score(docs: DataFrame, labels: DataFrame, train, key: str = "doc_id", text: str = "text", label: str = "quality",
                    settings: Settings = Settings()) -> DataFrame:
    """Score every document; ``train`` (a column over ``key``) tells whose labels may be learned.

    Labels that are null or belong to no document are left out; a document with several labels counts
    once for each. Only narrow rows of statistics are stored and joined, never texts.
    """
    stats = frames.written(statistics(docs, key, text), "quality-statistics")
    known = labels.where(F.col(label).isin(0, 1)).select(key, F.col(label).cast("int").alias("label"))
    labelled = stats.where(train).join(known, key).select(F.col(key).alias("key"), "stats", "label")
    return score(stats, fit(frames.materialize(labelled), settings), key)
