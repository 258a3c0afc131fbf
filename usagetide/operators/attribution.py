"""Exact additive attributions of a boosted-tree model, row by row.

For one leaf, the model restricted to a set of known features is a product: a
known feature contributes 1 or 0 (the row follows the path or not), an unknown
one the share of training rows that follow it. Its Shapley value needs, for
every number k, the sum of the products over all sets of k known features. These
are the coefficients of prod(share + inside * t) over the path's features: the
path is built up factor by factor, and each feature's own factor is divided out
again. That takes depth squared steps per leaf, for trees of any depth. The
trees are a few thousand numbers whatever the size of the data, so every task
gets a copy.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path
from .boosting import Forest, model_inputs
from .scoring import FEATURES, with_model_codes


class PathFeature(NamedTuple):
    """Interval (low, high] a feature must lie in, and the share of rows in it."""

    index: int
    low: float
    high: float
    share: float


class Leaf(NamedTuple):
    value: float
    features: list[PathFeature]


def read_nodes(spark: SparkSession, model: PipelineModel) -> tuple[pd.DataFrame, list[float]]:
    """Tree nodes and tree weights from the saved form of the model."""
    booster = model.stages[-1]
    path = scratch_path(spark, "trees")
    booster.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    return nodes.toPandas(), list(booster.treeWeights)


def leaves(spark: SparkSession, model: PipelineModel) -> list[Leaf]:
    """Every leaf on the log-odds scale with the features on its path."""
    nodes, weights = read_nodes(spark, model)
    out: list[Leaf] = []
    for tree_id, rows in nodes.groupby("treeID"):
        table = {row.id: row for row in rows.itertuples()}
        # The margin of the classifier is twice the weighted sum of its trees.
        scale = 2.0 * weights[tree_id]

        def cover(node) -> float:
            return float(node.impurityStats[0])

        def walk(node, path: dict[int, PathFeature]) -> None:
            if node.leftChild < 0:
                out.append(Leaf(scale * node.prediction, list(path.values())))
                return
            index = node.split["featureIndex"]
            threshold = float(node.split["leftCategoriesOrThreshold"][0])
            for child_id, bounds in ((node.leftChild, (-np.inf, threshold)), (node.rightChild, (threshold, np.inf))):
                child = table[child_id]
                share = cover(child) / cover(node)
                known = path.get(index, PathFeature(index, -np.inf, np.inf, 1.0))
                narrowed = PathFeature(
                    index, max(known.low, bounds[0]), min(known.high, bounds[1]), known.share * share
                )
                walk(child, {**path, index: narrowed})

        walk(table[0], {})
    return out


def base_value(forest: list[Leaf]) -> float:
    """Margin with no feature known."""
    return float(sum(leaf.value * np.prod([f.share for f in leaf.features]) for leaf in forest))


def set_weights(size: int) -> np.ndarray:
    """Shapley weight of a set of k others, for k = 0 .. size - 1."""
    return np.array([1.0 / (size * comb(size - 1, k)) for k in range(size)])


def extended(terms: np.ndarray, share: float, inside: np.ndarray) -> np.ndarray:
    """Coefficients, per row, of a product times (share + inside * t)."""
    out = np.zeros((len(terms), terms.shape[1] + 1))
    out[:, :-1] = terms * share
    out[:, 1:] += terms * inside[:, None]
    return out


def unwound(terms: np.ndarray, share: float, inside: np.ndarray) -> np.ndarray:
    """Coefficients of the product without one of its factors (share + inside * t); inside is 0 or 1."""
    out = np.empty((len(terms), terms.shape[1] - 1))
    carried = np.zeros(len(terms))
    for k in range(out.shape[1] - 1, -1, -1):
        # Divided from the highest power where the row is inside, by the share alone where it is not.
        carried = terms[:, k + 1] - share * carried
        out[:, k] = carried
    outside = inside == 0
    out[outside] = terms[outside, :-1] / share
    return out


def attribute_batch(x: np.ndarray, forest: list[Leaf]) -> np.ndarray:
    """Attribution of every feature for every row of ``x``."""
    out = np.zeros_like(x, dtype=np.float64)
    for leaf in forest:
        path = leaf.features
        inside = [((x[:, f.index] > f.low) & (x[:, f.index] <= f.high)).astype(np.float64) for f in path]
        terms = np.ones((len(x), 1))
        for f, known in zip(path, inside):
            terms = extended(terms, f.share, known)
        weights = set_weights(len(path)) if path else None
        for f, known in zip(path, inside):
            out[:, f.index] += leaf.value * (unwound(terms, f.share, known) @ weights) * (known - f.share)
    return out


def forest_leaves(forest: Forest) -> list[Leaf]:
    """Every leaf that training rows reach, with the features on its path; shares are of hessian sums."""
    out: list[Leaf] = []
    first_leaf = forest.feature.shape[1]
    for feature, threshold, value, cover in zip(forest.feature, forest.threshold, forest.value, forest.cover):

        def walk(node: int, path: dict[int, PathFeature]) -> None:
            if node >= first_leaf:
                out.append(Leaf(float(value[node - first_leaf]), list(path.values())))
                return
            index = int(feature[node])
            if index < 0:
                walk(2 * node + 1, path)
                return
            cut = float(threshold[node])
            for child, low, high in ((2 * node + 1, -np.inf, cut), (2 * node + 2, cut, np.inf)):
                known = path.get(index, PathFeature(index, -np.inf, np.inf, 1.0))
                share = known.share * float(cover[child] / cover[node])
                walk(child, {**path, index: PathFeature(index, max(known.low, low), min(known.high, high), share)})

        walk(0, {})
    return out


def attribution(model: PipelineModel | Forest, matrix: DataFrame, key: str = "company_id") -> DataFrame:
    """Per account: one attribution column per feature, the base value and the margin."""
    spark = matrix.sparkSession
    own = isinstance(model, Forest)
    forest = forest_leaves(model) if own else leaves(spark, model)
    base = base_value(forest) + (model.bias if own else 0.0)
    # Plain tuples: a broadcast value is unpickled without this package.
    plain = [(leaf.value, [tuple(feature) for feature in leaf.features]) for leaf in forest]
    shared = spark.sparkContext.broadcast(plain)
    if own:
        rows = matrix.select(key, *[c.alias(name) for name, c in zip(model.columns, model_inputs(model))])
    else:
        rows = with_model_codes(model, matrix).select(key, *[F.col(c).cast("double").alias(c) for c in FEATURES])
    key_type = rows.schema[key].dataType.simpleString()
    schema = ", ".join([f"{key} {key_type}", *[f"{c} double" for c in FEATURES], "base_value double", "margin double"])

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees = [Leaf(value, [PathFeature(*f) for f in path]) for value, path in shared.value]
        for batch in batches:
            values = attribute_batch(batch[FEATURES].to_numpy(dtype=np.float64), trees)
            out = pd.DataFrame(values, columns=FEATURES)
            out.insert(0, key, batch[key].to_numpy())
            out["base_value"] = base
            out["margin"] = values.sum(axis=1) + base
            yield out

    return rows.mapInPandas(explain, schema)


def feature_importance(attributions: DataFrame) -> DataFrame:
    """Mean absolute attribution per feature: one aggregate, then one row per feature."""
    means = attributions.agg(*[F.avg(F.abs(c)).alias(c) for c in FEATURES])
    return means.unpivot([], FEATURES, "feature", "mean_abs_attribution")


def top_features(importance: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` features with the largest mean absolute attribution."""
    return importance.orderBy(F.desc("mean_abs_attribution"), "feature").limit(n)
