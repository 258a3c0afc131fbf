"""Gradient boosting with second-order statistics, grown from histograms.

Every feature is cut into at most 255 bins at quantiles. A tree grows level by
level: one pass over the accounts sums gradients and hessians of the logistic
loss per node, feature and bin; the best cut of each node has the largest
regularised gain, and a leaf's value is -G / (H + lambda) times the learning
rate. Each tree sees one sample of the features and one of the rows; positives
weigh as much as all negatives together.

Accounts are stored in blocks of packed numbers. Several models can grow side by
side: an account has a fold, and model m learns from the accounts of all other
folds. With five folds, one pass per level serves all five models, and every
account gets a score from the model that has not seen it. The 70 / 30 split is
the case of one model that leaves out fold 0.

What a task sends on are histograms: models x nodes x features x bins numbers,
whatever the number of rows. They are added and searched for the best cut on
the executors; the driver receives one row for each node and feature. Sums are
whole numbers (gradients in units of 2^-24), so the trees do not depend on the
order of addition, on partitions or on repeated tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import materialize
from . import metrics as Q, scoring as S
from .whatif import Scenario


@dataclass(frozen=True)
class Settings:
    trees: int = 100
    depth: int = 4
    rate: float = 0.1
    row_share: float = 0.8
    feature_share: float = 0.8
    penalty: float = 1.0
    min_hessian: float = 1.0
    seed: int = 42
    bins: int = 255
    #: Accounts whose values set the bin edges: about so many, chosen by a hash of their id. All accounts are trained on.
    edge_rows: int = 50_000
    #: Margins are stored anew after so many trees.
    store_every: int = 10
    #: Accounts times models of a task, at least; with fewer, starting it would take longer than its work.
    task_rows: int = 16 * 8192
    #: Tasks that add up histograms, at most, and the histograms each gets, at least.
    adders: int = 32
    adder_rows: int = 2048


UNIT = float(1 << 24)
BLOCK_ROWS = 8192


@dataclass
class Forest:
    """Complete trees of one depth: node k has children 2k + 1 and 2k + 2; a feature of -1 sends every row left.

    ``value`` has one entry per leaf, ``cover`` the hessian sum of every node, leaves included.
    """

    columns: list[str]
    levels: dict[str, list[str]]
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    bias: float = 0.0

    @property
    def depth(self) -> int:
        return int(self.value.shape[1]).bit_length() - 1

    def leaf(self, x: np.ndarray, tree: int) -> np.ndarray:
        return _descend(x, self.feature[tree], self.threshold[tree], self.depth)

    def margin(self, x: np.ndarray, trees: Sequence[int] | None = None) -> np.ndarray:
        """Sum over ``trees`` (default: all, with the bias)."""
        total = np.full(len(x), self.bias if trees is None else 0.0)
        for t in range(len(self.value)) if trees is None else trees:
            total += self.value[t][self.leaf(x, t)]
        return total


def _descend(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
    """Leaf number of every row; a row goes right where its value lies above the cut."""
    # Values are taken by their place in memory, whether rows or columns lie together: three times as fast as by row and column.
    if x.flags.f_contiguous:
        values, row_step, column_step = x.ravel(order="F"), 1, len(x)
    else:
        values, row_step, column_step = x.ravel(), x.shape[1], 1
    node, rows = np.zeros(len(x), dtype=np.int64), np.arange(len(x)) * row_step
    for _ in range(depth):
        f = feature.take(node)
        node = 2 * node + 1 + ((f >= 0) & (values.take(rows + f * column_step) > cut.take(node)))
    return node - (2**depth - 1)


# ----------------------------------------------------------------- encoding


def category_levels(rows: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """The values of each category in alphabetical order; short lists."""
    found = rows.agg(*[F.collect_set(c).alias(c) for c in columns]).first()
    return {c: sorted(found[c]) for c in columns}


def category_code(column: str, names: Sequence[str]) -> Column:
    """The place of a category among ``names``; NULL and unseen ones share the next place."""
    place: Column = F.lit(float(len(names)))
    for k, name in enumerate(names):
        place = F.when(F.col(column) == F.lit(name), F.lit(float(k))).otherwise(place)
    return place


def encoded(rows: DataFrame, levels: dict[str, list[str]], outputs: dict[str, str] = S.ENCODED) -> DataFrame:
    return rows.withColumns({outputs[c]: category_code(c, names) for c, names in levels.items()})


def model_inputs(forest: Forest) -> list[Column]:
    """What a forest reads of a feature matrix, whatever codes it carries: codes of the fit, missing numbers as 0."""
    source = {out: c for c, out in S.ENCODED.items()}
    return [
        category_code(source[c], forest.levels[source[c]]) if source.get(c) in forest.levels else F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        for c in forest.columns
    ]


# ------------------------------------------------------------------- blocks


def bin_edges(rows: DataFrame, n: int, columns: Sequence[str], key: str, settings: Settings) -> list[np.ndarray]:
    """Upper edges of all bins but the last, per column, from a sample of bounded size."""
    share = min(1.0, settings.edge_rows / max(n, 1))
    place = F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit(settings.seed + 1)), 33) / float(2**31)
    sample = rows.where(place < F.lit(share)).select(*columns).toPandas().to_numpy(dtype=np.float64)
    edges = []
    for k in range(len(columns)):
        # A cut lies half-way between neighbouring values; at most ``bins`` - 1 of them.
        values = np.unique(sample[:, k]) if len(sample) else np.zeros(0)
        if len(values) > settings.bins:
            values = np.unique(np.quantile(sample[:, k], np.linspace(0, 1, settings.bins), method="lower"))
        edges.append((values[:-1] + values[1:]) / 2)
    return edges


def packed_blocks(rows: DataFrame, columns: Sequence[str], edges: list[np.ndarray], models: int, key: str) -> DataFrame:
    """Accounts in blocks: binned features, label, fold, hash and one margin for each model."""
    source = rows.select(
        F.xxhash64(F.col(key)).alias("row_hash"), F.col("label").cast("int").alias("label"), F.col("fold").cast("int").alias("fold"),
        *[F.col(c).cast("double").alias(c) for c in columns],
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                get = lambda k: part.column(k).to_numpy(zero_copy_only=False)
                # Column after column.
                x = np.stack([np.searchsorted(e, get(3 + k), side="left") for k, e in enumerate(edges)])
                fields = [
                    x.astype(np.uint8), get(1).astype(np.uint8), get(2).astype(np.int8), get(0).astype(np.int64),
                    np.zeros((part.num_rows, models)),
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.num_rows], pa.int32()), *[pa.array([f.tobytes()], pa.binary()) for f in fields]],
                    names=["n", "x", "y", "fold", "hash", "margin"],
                )

    return source.mapInArrow(pack, "n int, x binary, y binary, fold binary, hash binary, margin binary")


@dataclass
class _Growing:
    """Trees of all models so far, in bins: lists over models of (feature, cut, value) arrays, since margins were stored."""

    models: int
    columns: int
    depth: int
    #: Tasks that add up histograms; 0 if there is one task of accounts.
    adders: int
    recent: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = field(default_factory=list)

    def read(self, batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, ...]:
        n = batch.column(0)[row].as_py()
        raw = [batch.column(k)[row].as_py() for k in range(1, 6)]
        x = np.frombuffer(raw[0], np.uint8).reshape(self.columns, n).T
        y, fold, keys = (np.frombuffer(b, t) for b, t in zip(raw[1:4], (np.uint8, np.int8, np.uint64)))
        margin = np.frombuffer(raw[4], np.float64).reshape(n, self.models).copy()
        for tree in self.recent:
            for m, (feature, cut, value) in enumerate(tree):
                margin[:, m] += value[_descend(x, feature, cut, self.depth)]
        return x, y, fold, keys, margin


def _chosen(keys: np.ndarray, tree: int, seed: int, share: float) -> np.ndarray:
    """The rows of a tree's sample: a hash of row and tree below ``share``."""
    z = keys + np.uint64((0x9E3779B97F4A7C15 * (tree + 1) + seed) % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) < share * 2.0**53


def gradients(margin: np.ndarray, y: np.ndarray, positive_weight: float) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the weighted logistic loss, in whole units."""
    p = 1.0 / (1.0 + np.exp(-margin))
    w = np.where(y == 1, positive_weight, 1.0)
    return np.rint(w * (p - y) * UNIT), np.rint(w * p * (1.0 - p) * UNIT)


def best_cut(g: np.ndarray, h: np.ndarray, penalty: float, least: float) -> tuple[float, int, int, int]:
    """Gain, last bin on the left, and G and H there, of the best cut of one histogram; a gain of 0 if there is none."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    total_g, total_h = int(g.sum()), int(h.sum())
    left_g, left_h = gl / UNIT, hl / UNIT
    right_g, right_h = (total_g - gl) / UNIT, (total_h - hl) / UNIT
    score = lambda a, b: a * a / (b + penalty)
    gain = (score(left_g, left_h) + score(right_g, right_h) - score(total_g / UNIT, total_h / UNIT)) / 2
    gain[(left_h < least) | (right_h < least)] = 0.0
    k = int(np.argmax(gain)) if len(gain) else 0
    if not len(gain) or gain[k] <= 1e-6:
        return 0.0, 0, 0, 0
    return float(gain[k]), k, int(gl[k]), int(hl[k])


_HISTOGRAM = "slot int, feature int, g binary, h binary"
_CUT = "slot int, feature int, gain double, cut int, left_g long, left_h long, all_g long, all_h long"


def _level(
    blocks: DataFrame, state: _Growing, nodes: list[tuple[np.ndarray, np.ndarray]], level: int, tree: int,
    features: list[np.ndarray], weights: Sequence[float], settings: Settings,
) -> list:
    """The best cut of every node of a level and every feature of its sample."""
    models, bins = state.models, settings.bins + 1
    width = 2**level

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((2, len(features[m]), width * bins)) for m in range(models)]
        for batch in batches:
            for row in range(batch.num_rows):
                x, y, fold, keys, margin = state.read(batch, row)
                drawn = _chosen(keys, tree, settings.seed, settings.row_share)
                for m in range(models):
                    mine = np.flatnonzero(drawn & (fold != m))
                    own = x.T.take(mine, axis=1).T
                    g, h = gradients(margin[mine, m], y[mine], weights[m])
                    at = _descend(own, *nodes[m], level) * bins
                    for k, f in enumerate(features[m]):
                        place = at + own[:, f]
                        total[m][0, k] += np.bincount(place, g, width * bins)
                        total[m][1, k] += np.bincount(place, h, width * bins)
        rows = [
            (m * width + node, int(f), *(total[m][part, k, node * bins : (node + 1) * bins].astype(np.int64).tobytes() for part in (0, 1)))
            for m in range(models) for k, f in enumerate(features[m]) for node in range(width)
        ]
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["slot", "feature", "g", "h"])

    def cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One histogram for each node and feature, however many tasks there were.
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for slot, f, g, h in zip(*(batch.column(k).to_pylist() for k in range(4))):
                now = np.stack((np.frombuffer(g, np.int64), np.frombuffer(h, np.int64)))
                held[slot, f] = held[slot, f] + now if (slot, f) in held else now
        rows = []
        for (slot, f), (g, h) in held.items():
            rows.append((slot, f, *best_cut(g, h, settings.penalty, settings.min_hessian), int(g.sum()), int(h.sum())))
        if rows:
            kinds = (pa.int32(), pa.int32(), pa.float64(), pa.int32(), *[pa.int64()] * 4)
            names = [c.split()[0] for c in _CUT.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    if not state.adders:
        return blocks.mapInArrow(lambda batches: cuts(sums(batches)), _CUT).collect()
    return blocks.mapInArrow(sums, _HISTOGRAM).repartition(state.adders, "slot", "feature").mapInArrow(cuts, _CUT).collect()


def _grow(
    blocks: DataFrame, state: _Growing, tree: int, features: list[np.ndarray], weights: Sequence[float], settings: Settings
) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """One tree for every model: feature, cut (a bin), leaf values and covers."""
    depth, inner = settings.depth, 2**settings.depth - 1
    feature = [np.full(inner, -1, dtype=np.int64) for _ in range(state.models)]
    cut = [np.zeros(inner, dtype=np.int64) for _ in range(state.models)]
    sums = [np.zeros((2 * inner + 1, 2), dtype=np.int64) for _ in range(state.models)]
    for level in range(depth):
        width, first = 2**level, 2**level - 1
        best: dict[int, tuple] = {}
        for r in _level(blocks, state, list(zip(feature, cut)), level, tree, features, weights, settings):
            rank = (-r.gain, r.feature)
            if r.slot not in best or rank < best[r.slot][0]:
                best[r.slot] = (rank, r)
        for slot, (_, r) in best.items():
            m, node = slot // width, first + slot % width
            sums[m][node] = (r.all_g, r.all_h)
            left, right = 2 * node + 1, 2 * node + 2
            if r.gain > 0:
                feature[m][node], cut[m][node] = r.feature, r.cut
                sums[m][left] = (r.left_g, r.left_h)
                sums[m][right] = (r.all_g - r.left_g, r.all_h - r.left_h)
            else:
                sums[m][left] = sums[m][node]
                sums[m][right] = 0
    out = []
    for m in range(state.models):
        g, h = sums[m][inner:, 0] / UNIT, sums[m][inner:, 1] / UNIT
        out.append((feature[m], cut[m], -settings.rate * g / (h + settings.penalty), sums[m][:, 1] / UNIT))
    return out


def _stored_margins(blocks: DataFrame, state: _Growing) -> DataFrame:
    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                margin = state.read(batch, row)[4]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(row, 1) for k in range(5)] + [pa.array([margin.tobytes()], pa.binary())], names=batch.schema.names
                )

    return materialize(blocks.mapInArrow(update, blocks.schema))


def pass_tasks(rows: int, slots: int, task_rows: int) -> int:
    """Tasks of a pass over ``rows`` accounts times models, of which ``slots`` run at a time.

    Every level is a short job, whose time is that of starting tasks until these have some rows each. Beyond one task
    for each slot, tasks get longer first (they read block by block), then more: in full turns of all slots.
    """
    wanted = -(-max(rows, 1) // task_rows)
    return wanted if wanted <= slots else slots * -(-wanted // (8 * slots))


def boost(
    rows: DataFrame, columns: Sequence[str], levels: dict[str, list[str]], weights: Sequence[float],
    settings: Settings = Settings(), key: str = "company_id",
) -> list[Forest]:
    """One forest for each entry of ``weights`` (what a positive weighs); model m learns from rows whose ``fold`` is not m."""
    models = len(weights)
    n = rows.count()
    edges = bin_edges(rows, n, columns, key, settings)
    tasks = pass_tasks(n * models, rows.sparkSession.sparkContext.defaultParallelism, settings.task_rows)
    blocks = materialize(packed_blocks(rows.repartition(tasks, key), columns, edges, models, key))
    wanted = max(1, int(settings.feature_share * len(columns)))
    histograms = tasks * models * wanted * 2 ** max(settings.depth - 1, 0)
    adders = min(tasks, settings.adders, -(-histograms // settings.adder_rows)) if tasks > 1 else 0
    state = _Growing(models, len(columns), settings.depth, adders)
    grown: list[list[tuple]] = [[] for _ in range(models)]
    for tree in range(settings.trees):
        rng = np.random.default_rng([settings.seed, tree])
        sample = np.sort(rng.permutation(len(columns))[:wanted])
        new = _grow(blocks, state, tree, [sample] * models, weights, settings)
        state.recent.append([t[:3] for t in new])
        for m, t in enumerate(new):
            grown[m].append(t)
        if len(state.recent) == settings.store_every and tree + 1 < settings.trees:
            blocks = _stored_margins(blocks, state)
            state.recent = []
    return [_as_forest(list(columns), levels, edges, trees, settings) for trees in grown]


def _as_forest(columns: list[str], levels: dict, edges: list[np.ndarray], trees: list[tuple], settings: Settings) -> Forest:
    """The trees with cuts as values of the features instead of bins."""
    feature = np.array([t[0] for t in trees], dtype=np.int64).reshape(-1, 2**settings.depth - 1)
    cut = np.array([t[1] for t in trees], dtype=np.int64).reshape(feature.shape)
    threshold = np.zeros(feature.shape)
    for place in np.argwhere(feature >= 0):
        threshold[tuple(place)] = edges[feature[tuple(place)]][cut[tuple(place)]]
    value = np.array([t[2] for t in trees]).reshape(-1, 2**settings.depth)
    cover = np.array([t[3] for t in trees]).reshape(-1, 2 ** (settings.depth + 1) - 1)
    return Forest(columns, levels, feature, threshold, value, cover)


# ----------------------------------------------------------- churn model


def _training_rows(features: DataFrame) -> tuple[DataFrame, dict[str, list[str]]]:
    stored = materialize(S._numbers_and_label(features.select("company_id", S.LABEL, *S.ENCODED, *S.NUMERIC_FEATURES)))
    levels = category_levels(stored, list(S.ENCODED))
    return encoded(stored, levels), levels


def _weights(rows: DataFrame, models: int) -> list[float]:
    """Negatives per positive among the rows each model learns from; one positive is assumed where there is none."""
    counts = {tuple(r)[:2]: r.n for r in rows.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = []
    for m in range(models):
        side = [sum(n for (fold, label), n in counts.items() if fold != m and label == want) for want in (0.0, 1.0)]
        out.append(side[0] / max(side[1], 1))
    return out


def train(features: DataFrame, settings: Settings = Settings()) -> Forest:
    """The churn model, fitted on the 70 % side of the split."""
    rows, levels = _training_rows(features)
    split = S.stratified_split(rows).withColumn("fold", F.when(F.col("is_test"), 0).otherwise(1))
    split = materialize(split.drop("is_test"))
    return boost(split, S.FEATURES, levels, _weights(split, 1), settings)[0]


def out_of_fold(features: DataFrame, folds: int = 5, settings: Settings = Settings()) -> DataFrame:
    """``company_id``, ``label``, ``fold`` and ``probability`` from the model that left the account's fold out.

    All models grow together: one pass over the accounts for each level of a tree, whatever the number of folds.
    """
    rows, levels = _training_rows(features)
    parted = materialize(S.stratified_folds(rows, folds))
    forests = boost(parted, S.FEATURES, levels, _weights(parted, folds), settings)
    return _scored(
        parted.select("company_id", "label", "fold", *S.FEATURES), S.FEATURES, lambda x, fold: _by_fold(forests, x, fold), "probability", "fold"
    ).drop(*S.FEATURES)


def _by_fold(forests: list[Forest], x: np.ndarray, fold: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x))
    for m, forest in enumerate(forests):
        mine = np.flatnonzero(fold == m)
        out[mine] = forest.margin(x[mine])
    return 1.0 / (1.0 + np.exp(-out))


def _scored(rows: DataFrame, columns: Sequence[str], work: Callable, output: str, *extra: str) -> DataFrame:
    """``rows`` with ``output`` = ``work(values of columns, extra columns...)``, batch by batch."""

    @F.pandas_udf("double")
    def apply(values: pd.DataFrame) -> pd.Series:
        x = values.iloc[:, : len(columns)].to_numpy(dtype=np.float64)
        return pd.Series(work(x, *[values.iloc[:, len(columns) + k].to_numpy() for k in range(len(extra))]))

    return rows.withColumn(output, apply(F.struct(*columns, *extra)))


def score(forest: Forest, matrix: DataFrame, output: str = "probability") -> DataFrame:
    """Add the churn probability of each row of a feature matrix, whatever codes ``matrix`` carries."""
    kept = [c for c in matrix.columns if c != output]
    names = [f"score_in_{k}" for k in range(len(forest.columns))]
    inputs = matrix.select(*kept, *[c.alias(n) for c, n in zip(model_inputs(forest), names)])
    return _scored(inputs, names, lambda x: 1.0 / (1.0 + np.exp(-forest.margin(x))), output).select(*kept, output)


def holdout(features: DataFrame, forest: Forest) -> DataFrame:
    """``company_id``, ``label`` and ``probability`` of the 30 % side that the model has not seen."""
    matrix = S._numbers_and_label(features)
    test = S.stratified_split(matrix).where("is_test")
    return score(forest, test).select("company_id", F.col("label").cast("int").alias("label"), "probability")


def fold_metrics(scores: DataFrame, folds: int = 5) -> DataFrame:
    """Mean and population deviation of the folds' ROC-AUC, and the AUC of all out-of-fold scores together."""
    parts = None
    for m in range(folds):
        part = Q.roc_auc(scores.where(F.col("fold") == m), "probability", "label")
        parts = part if parts is None else parts.unionByName(part)
    whole = Q.roc_auc(scores, "probability", "label").select("roc_auc").scalar()
    return parts.agg(
        F.count("roc_auc").cast("int").alias("folds"), F.avg("roc_auc").alias("mean_auc"), F.stddev_pop("roc_auc").alias("std_auc")
    ).withColumn("out_of_fold_auc", whole)


def cross_validate(features: DataFrame, folds: int = 5, settings: Settings = Settings()) -> DataFrame:
    return fold_metrics(materialize(out_of_fold(features, folds, settings)), folds)


# ------------------------------------------------------------ scenarios


def touched_trees(forest: Forest, columns: Sequence[str]) -> list[int]:
    """Trees with one of ``columns`` on a path: all others score a row alike, whatever these columns hold."""
    wanted = [k for k, c in enumerate(forest.columns) if c in columns]
    return [t for t in range(len(forest.feature)) if np.isin(forest.feature[t], wanted).any()]


def scenario_factors(forest: Forest, scenario: Scenario) -> dict[int, float]:
    """Place of each scaled column and its factor, found by name; factors of 1 are left out."""
    factors = {}
    for k, c in enumerate(forest.columns):
        factor = (scenario.ttft_mult if "ttft" in c.lower() else 1.0) * (1.0 - scenario.rl_red if "429" in c else 1.0)
        if factor != 1.0:
            factors[k] = factor
    return factors


@dataclass(frozen=True)
class ForestScorer:
    """Scores a matrix with a forest; scenarios change a score by the trees they touch alone."""

    forest: Forest

    def __call__(self, rows: DataFrame) -> DataFrame:
        return score(self.forest, rows)

    def risks(self, x: np.ndarray, scenarios: Sequence[Scenario]) -> np.ndarray:
        """Probability of every row before (first column) and under every scenario.

        All trees are evaluated once. A scenario adds, for each tree that has a scaled column on a path, what the
        scaled row's leaf is worth more than the row's own; rows that the scaling leaves as they are skip that.
        """
        forest = self.forest
        margin = forest.margin(x)
        out = np.tile(margin[:, None], (1, len(scenarios) + 1))
        own: dict[int, np.ndarray] = {}
        for k, scenario in enumerate(scenarios):
            factors = scenario_factors(forest, scenario)
            moved = np.flatnonzero((x[:, list(factors)] != 0).any(axis=1)) if factors else np.zeros(0, np.int64)
            if not len(moved):
                continue
            scaled = x[moved]
            for c, factor in factors.items():
                scaled[:, c] *= factor
            for t in touched_trees(forest, [forest.columns[c] for c in factors]):
                if t not in own:
                    own[t] = forest.value[t][forest.leaf(x, t)]
                out[moved, k + 1] += forest.value[t][forest.leaf(scaled, t)] - own[t][moved]
        return 1.0 / (1.0 + np.exp(-out))

    def rescored(self, matrix: DataFrame, scenarios: Sequence[Scenario]) -> DataFrame:
        """Accounts per scenario with ``baseline_risk`` and ``new_risk``, in one pass over the accounts."""
        names = [f"score_in_{k}" for k in range(len(self.forest.columns))]
        scorer = self

        @F.pandas_udf("array<double>")
        def apply(values: pd.DataFrame) -> pd.Series:
            return pd.Series(list(scorer.risks(values.to_numpy(dtype=np.float64), scenarios)))

        inputs = matrix.select(*matrix.columns, *[c.alias(n) for c, n in zip(model_inputs(self.forest), names)])
        risked = inputs.withColumn("scenario_risks", apply(F.struct(*names))).drop(*names)
        rows = [
            F.struct(
                F.lit(k).alias("scenario_no"), F.lit(s.name).alias("scenario"), F.lit(float(s.ttft_mult)).alias("ttft_mult"),
                F.lit(float(s.rl_red)).alias("rl_red"), F.col("scenario_risks")[k + 1].alias("new_risk"),
            )
            for k, s in enumerate(scenarios)
        ]
        return risked.select(*matrix.columns, F.col("scenario_risks")[0].alias("baseline_risk"), F.inline(F.array(*rows)))


# ---------------------------------------------------------- certificates


def split_certificate(features: DataFrame, forest: Forest, settings: Settings = Settings()) -> DataFrame:
    """How far the leaves of the last tree are from the least regularised second-order loss, per leaf.

    Margins before the last tree, its row sample, gradients and hessians are computed anew from the feature table.
    ``residual`` is rate * G + value * (H + penalty), and 0 at the optimum; ``n`` counts the sampled rows of the leaf.
    """
    rows, _ = _training_rows(features)
    train = S.stratified_split(rows).where("NOT is_test")
    weight = _weights(train.withColumn("fold", F.lit(1)), 1)[0]
    last = len(forest.value) - 1
    columns = forest.columns

    def stats(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch[columns].to_numpy(dtype=np.float64)
            drawn = _chosen(batch["row_hash"].to_numpy().astype(np.int64).view(np.uint64), last, settings.seed, settings.row_share)
            g, h = gradients(forest.margin(x, range(last)), batch["label"].to_numpy(), weight)
            yield pd.DataFrame({"leaf": forest.leaf(x, last), "g": g.astype(np.int64), "h": h.astype(np.int64)})[drawn]

    source = train.select(F.xxhash64("company_id").alias("row_hash"), "label", *[F.col(c).cast("double").alias(c) for c in columns])
    sums = source.mapInPandas(stats, "leaf long, g long, h long").groupBy("leaf").agg(
        F.sum("g").alias("g"), F.sum("h").alias("h"), F.count(F.lit(1)).alias("n")
    )
    value = F.element_at(F.array(*[F.lit(float(v)) for v in forest.value[last]]), (F.col("leaf") + 1).cast("int"))
    residual = settings.rate * F.col("g") / UNIT + value * (F.col("h") / UNIT + settings.penalty)
    return sums.select("leaf", "n", residual.alias("residual"))


# ------------------------------------------------------------------ storage

_TREE = "tree int, feature array<long>, threshold array<double>, value array<double>, cover array<double>"


def save_forest(spark: SparkSession, forest: Forest, path: str) -> str:
    """One row per tree, and one (tree -1) with names and levels."""
    arrays = [forest.feature, forest.threshold, forest.value, forest.cover]
    rows = [(t, *[a[t].tolist() for a in arrays], None, None, None) for t in range(len(forest.value))]
    rows.append((-1, None, None, None, None, forest.columns, forest.levels, forest.bias))
    schema = f"{_TREE}, columns array<string>, levels map<string, array<string>>, bias double"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)
    return path


def load_forest(spark: SparkSession, path: str) -> Forest:
    rows = sorted(spark.read.parquet(path).collect(), key=lambda r: r.tree)
    head, trees = rows[0], rows[1:]
    arrays = [np.array([r[c] for r in trees]) for c in ("feature", "threshold", "value", "cover")]
    return Forest(head["columns"], dict(head.levels), *arrays, head.bias)
