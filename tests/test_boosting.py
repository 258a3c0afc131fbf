"""Histogram boosting against a plain loop, folds side by side, scenarios by touched trees, and attributions."""

import random
from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from usagetide.operators import attribution as A
from usagetide.operators import boosting as G
from usagetide.operators import metrics as Q
from usagetide.operators import scoring as S
from usagetide.operators import whatif as W

FEW = G.Settings(trees=4, depth=3, store_every=2, task_rows=60, min_hessian=0.5)


@pytest.fixture(scope="module")
def features(spark):
    rng = random.Random(5)
    rows = []
    for i in range(240):
        x = [float(rng.randrange(20)) for _ in S.NUMERIC_FEATURES]
        churned = x[0] + x[4] + rng.random() * 8 > 24
        x[6] = None if i % 7 == 0 else x[6]
        tier = ("Enterprise", "Growth", None)[i % 3]
        rows.append((f"c{i:03d}", f"Co {i}", ("Tech", "Legal")[i % 2], tier, churned, *x))
    columns = ", ".join(f"{c} double" for c in S.NUMERIC_FEATURES)
    return spark.createDataFrame(
        rows, f"company_id string, company_name string, industry string, contract_tier string, hard_churn_label boolean, {columns}"
    )


@pytest.fixture(scope="module")
def forest(features):
    return G.train(features, FEW)


def plain_trees(x, y, keys, weight, settings):
    """The same boosting by loops over rows and values, without bins, histograms or Spark."""
    margin = np.zeros(len(x))
    trees = []
    for t in range(settings.trees):
        allowed = np.sort(np.random.default_rng([settings.seed, t]).permutation(x.shape[1])[: int(0.8 * x.shape[1])])
        drawn = G._chosen(keys, t, settings.seed, settings.row_share)
        p = 1 / (1 + np.exp(-margin))
        w = np.where(y == 1, weight, 1.0)
        g, h = w * (p - y), w * p * (1 - p)

        def grow(rows, depth):
            def score(part):
                return g[part].sum() ** 2 / (h[part].sum() + settings.penalty)

            best = (1e-6, None)
            for f in allowed if depth < settings.depth else []:
                values = np.unique(x[:, f])
                for cut in (values[:-1] + values[1:]) / 2:
                    left, right = [r for r in rows if x[r, f] <= cut], [r for r in rows if x[r, f] > cut]
                    if h[left].sum() < settings.min_hessian or h[right].sum() < settings.min_hessian:
                        continue
                    gain = (score(left) + score(right) - score(rows)) / 2
                    if gain > best[0] + 1e-7:
                        best = (gain, (f, cut, left, right))
            if best[1] is None:
                return -settings.rate * g[rows].sum() / (h[rows].sum() + settings.penalty)
            f, cut, left, right = best[1]
            return (f, cut, grow(left, depth + 1), grow(right, depth + 1))

        tree = grow(list(np.flatnonzero(drawn)), 0)

        def value(row):
            node = tree
            while isinstance(node, tuple):
                node = node[2] if row[node[0]] <= node[1] else node[3]
            return node

        trees.append(tree)
        margin += [value(row) for row in x]
    return margin


def test_equals_a_plain_loop(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 12, (150, 5)).astype(float)
    y = (x[:, 0] + x[:, 1] * 0.5 + rng.random(150) * 4 > 11).astype(int)
    rows = spark.createDataFrame(
        [(i, int(y[i]), 1, *map(float, x[i])) for i in range(150)], "company_id long, label int, fold int, a double, b double, c double, d double, e double"
    ).repartition(3)
    (forest,) = G.boost(rows, list("abcde"), {}, [2.5], FEW)
    keys = np.array([r[0] for r in rows.orderBy("company_id").select(F.xxhash64("company_id")).collect()]).view(np.uint64)
    assert forest.margin(x) == pytest.approx(plain_trees(x, y, keys, 2.5, FEW), abs=1e-5)
    assert len(np.unique(np.round(forest.margin(x), 6))) > 10


def test_trees_do_not_depend_on_partitions(features, forest):
    again = G.train(features.repartition(7), G.Settings(trees=4, depth=3, store_every=3, task_rows=1000, min_hessian=0.5))
    for name in ("feature", "threshold", "value", "cover"):
        assert (getattr(again, name) == getattr(forest, name)).all()


def test_passes_start_no_more_tasks_than_they_need():
    default = G.Settings().task_rows
    # 90,000 accounts are one task; five models side by side share the slots there are.
    assert G.pass_tasks(0, 12, default) == G.pass_tasks(90_000, 12, default) == 1
    assert G.pass_tasks(540_000, 12, default) == 5 and G.pass_tasks(5 * 90_000, 12, default) == 4
    # Then tasks grow to eight times that, in one turn of all slots, and come in full turns after it.
    assert G.pass_tasks(5 * 540_000, 12, default) == G.pass_tasks(8 * 12 * default, 12, default) == 12
    assert G.pass_tasks(8 * 12 * default + 1, 12, default) == 24
    assert G.pass_tasks(8 * 12 * 40 * default, 12, default) == 12 * 40


def test_few_histograms_meet_in_few_tasks(features, forest):
    """However the histograms are dealt, or added where they were made, the trees are the same."""
    for settings in (
        G.Settings(trees=4, depth=3, task_rows=60, min_hessian=0.5, adder_rows=50),
        G.Settings(trees=4, depth=3, task_rows=60, min_hessian=0.5, adders=1),
        G.Settings(trees=4, depth=3, min_hessian=0.5),
    ):
        again = G.train(features, settings)
        for name in ("feature", "threshold", "value", "cover"):
            assert (getattr(again, name) == getattr(forest, name)).all()


@pytest.mark.parametrize("depth", [0, 1, 4, 6])
def test_rows_descend_alike_however_they_lie_in_memory(depth):
    rng = np.random.default_rng(depth)
    x = rng.integers(0, 9, (50, 7)).astype(np.uint8)
    feature, cut = rng.integers(-1, 7, 2**depth - 1), rng.integers(0, 9, 2**depth - 1)
    want = []
    for row in x:
        node = 0
        while node < 2**depth - 1:
            node = 2 * node + 1 + int(feature[node] >= 0 and row[feature[node]] > cut[node])
        want.append(node - (2**depth - 1))
    for kind in (x, np.asfortranarray(x), np.repeat(x, 2, axis=0)[::2]):
        assert G._descend(kind, feature, cut, depth).tolist() == want
    assert G._descend(x[:0], feature, cut, depth).tolist() == []


def test_models_side_by_side_equal_models_alone(spark, features):
    rows, levels = G._training_rows(features)
    parted = S.stratified_folds(rows, 3).persist()
    together = G.boost(parted, S.FEATURES, levels, [1.0, 2.0, 3.0], FEW)
    for m, weight in enumerate((1.0, 2.0, 3.0)):
        alone = G.boost(parted.withColumn("fold", F.when(F.col("fold") == m, 0).otherwise(1)), S.FEATURES, levels, [weight], FEW)[0]
        assert (alone.feature == together[m].feature).all() and (alone.value == together[m].value).all()
    parted.unpersist()


def auc(pairs):
    wins = [(p > q) + (p == q) / 2 for p, a in pairs if a for q, b in pairs if not b]
    return sum(wins) / len(wins)


def test_cross_validation_and_hold_out(features, forest):
    settings = G.Settings(trees=4, depth=3)
    scores = G.out_of_fold(features, 3, settings).collect()
    assert len(scores) == 240 and {r.fold for r in scores} == {0, 1, 2}
    folds = [auc([(r.probability, r.label) for r in scores if r.fold == m]) for m in range(3)]
    row = G.cross_validate(features, 3, settings).first()
    assert row.folds == 3 and row.mean_auc == pytest.approx(np.mean(folds)) and row.std_auc == pytest.approx(np.std(folds))
    assert row.out_of_fold_auc == pytest.approx(auc([(r.probability, r.label) for r in scores])) and row.mean_auc > 0.6
    test = G.holdout(features, forest)
    rows = test.collect()
    wanted = {r.company_id for r in S.stratified_split(features).where("is_test").collect()}
    assert {r.company_id for r in rows} == wanted
    assert Q.roc_auc(test, "probability", "label").first()[0] == pytest.approx(auc([(r.probability, r.label) for r in rows]))


def test_forest_scores_saves_and_loads(spark, features, forest, tmp_path):
    matrix = S.feature_matrix(features)
    one = {r.company_id: r.probability for r in G.score(forest, matrix).collect()}
    back = G.load_forest(spark, G.save_forest(spark, forest, str(tmp_path / "forest")))
    assert {r.company_id: r.probability for r in G.score(back, matrix).collect()} == one
    part = {r.company_id: r.probability for r in G.score(forest, features.where("industry = 'Tech'")).collect()}
    assert part and all(one[k] == p for k, p in part.items())
    assert G.score(forest, matrix).columns == [*matrix.columns, "probability"]
    unseen = features.withColumn("industry", F.lit("none of them"))
    assert all(0 < r.probability < 1 for r in G.score(forest, unseen).collect())
    assert G.score(forest, features.limit(0)).count() == 0


def test_touched_trees_give_what_full_scoring_gives(features):
    forest = G.train(features, G.Settings(trees=12, depth=3, min_hessian=0.5))
    matrix = S.feature_matrix(features).withColumn("score_in", F.lit("x"))
    scorer = G.ForestScorer(forest)
    got = scorer.rescored(matrix, W.SCENARIOS).select("company_id", "scenario_no", "baseline_risk", "new_risk").collect()
    whole = W.rescored(matrix, lambda rows: G.score(forest, rows), W.SCENARIOS).select("company_id", "scenario_no", "baseline_risk", "new_risk").collect()
    want = {(r.company_id, r.scenario_no): (r.baseline_risk, r.new_risk) for r in whole}
    assert len(got) == len(want) == 5 * 240
    for r in got:
        assert (r.baseline_risk, r.new_risk) == pytest.approx(want[r.company_id, r.scenario_no], abs=1e-12)
    assert all(r.baseline_risk == r.new_risk for r in got if r.scenario_no == 0)
    names = [c for c in forest.columns if "429" in c]
    touched = G.touched_trees(forest, names)
    assert 0 < len(touched) < 12
    table = W.counterfactual_scenarios(matrix, scorer).collect()
    assert [tuple(r) for r in table] == [tuple(r) for r in W.counterfactual_scenarios(matrix, lambda rows: G.score(forest, rows)).collect()]
    assert W.saved_accounts(matrix, scorer, 50, 100).count() == W.what_if(matrix, scorer, 50, 100).first()["accounts_moved_to_safe"]


def test_attributions_of_the_forest_add_up(features, forest):
    matrix = S.feature_matrix(features)
    p = {r.company_id: r.probability for r in G.score(forest, matrix).collect()}
    for r in A.attribution(forest, matrix).collect():
        assert r.margin == pytest.approx(np.log(p[r.company_id] / (1 - p[r.company_id])), abs=1e-9)
        assert sum(r[c] for c in S.FEATURES) + r.base_value == pytest.approx(r.margin)


@pytest.mark.parametrize("depth", [0, 1, 2, 5, 8])
def test_path_attribution_is_the_shapley_value(depth):
    rng = np.random.default_rng(depth)
    n = max(depth, 1)
    path = [A.PathFeature(k, float(a), float(a + 0.6), float(s)) for k, (a, s) in enumerate(zip(rng.random(depth) * 0.5, rng.random(depth) * 0.9 + 0.05))]
    leaf = A.Leaf(1.7, path)
    x = rng.random((12, n))
    got = A.attribute_batch(x, [leaf])
    for row, values in zip(x, got):
        inside = [float(f.low < row[f.index] <= f.high) for f in path]

        def worth(known):
            return leaf.value * np.prod([inside[k] if k in known else f.share for k, f in enumerate(path)])

        for i in range(depth):
            others = [j for j in range(depth) if j != i]
            want = sum(
                factorial(k) * factorial(depth - k - 1) / factorial(depth) * (worth({*s, i}) - worth(set(s)))
                for k in range(depth) for s in combinations(others, k)
            )
            assert values[i] == pytest.approx(want, abs=1e-12)


def test_leaves_of_the_last_tree_are_optimal(features, forest):
    rows = G.split_certificate(features, forest, FEW).collect()
    assert rows and all(abs(r.residual) < 1e-6 for r in rows)
    drawn = sum(r.n for r in rows)
    assert 0.6 * 168 < drawn < 168


def test_one_class_and_no_rows(spark, features):
    calm = features.withColumn("hard_churn_label", F.lit(False))
    forest = G.train(calm, G.Settings(trees=2))
    assert all(r.probability < 0.5 for r in G.score(forest, S.feature_matrix(calm)).collect())
    none = G.train(features.limit(0), G.Settings(trees=1))
    assert none.value.shape[0] == 1 and G.score(none, features).count() == 240
