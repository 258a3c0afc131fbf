import random
from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from usagetide.operators import attribution as A
from usagetide.operators import scoring as S
from usagetide.operators import whatif as W


@pytest.fixture(scope="module")
def features(spark):
    rng = random.Random(5)
    rows = []
    for i in range(120):
        x = [float(rng.randrange(20)) for _ in S.NUMERIC_FEATURES]
        churned = x[0] + x[4] + rng.random() * 8 > 24
        x[6] = None if i % 7 == 0 else x[6]
        tier = ("Enterprise", "Growth", "Other")[i % 3]
        rows.append((f"c{i:03d}", f"Co {i}", ("Tech", "Legal")[i % 2], tier, churned, *x))
    columns = ", ".join(f"{c} double" for c in S.NUMERIC_FEATURES)
    return spark.createDataFrame(
        rows,
        f"company_id string, company_name string, industry string, contract_tier string, hard_churn_label boolean, {columns}",
    )


@pytest.fixture(scope="module")
def model(features):
    return S.train_churn_model(features, trees=4)


def test_matrix_fills_and_encodes(features):
    rows = S.feature_matrix(features).collect()
    assert {(r["industry"], r["industry_enc"]) for r in rows} == {("Legal", 0.0), ("Tech", 1.0)}
    assert all(r["avg_ttft_days_0_14"] is not None for r in rows)


def test_split_and_folds_keep_label_shares(features):
    split = S.stratified_split(features)
    n = {r[0]: (r[1], r[2]) for r in split.groupBy(S.LABEL).agg(F.count("*"), F.count_if("is_test")).collect()}
    assert all(test == int(total * 0.3 + 0.5) for total, test in n.values())
    again = {r["company_id"] for r in S.stratified_split(features.repartition(7)).where("is_test").collect()}
    assert again == {r["company_id"] for r in split.where("is_test").collect()}
    folds = S.stratified_folds(features).groupBy(S.LABEL, "fold").count().collect()
    for label in (True, False):
        sizes = [r["count"] for r in folds if r[S.LABEL] == label]
        assert max(sizes) - min(sizes) <= 1


def test_class_weight_without_positives(spark):
    df = spark.createDataFrame([(False,), (False,)], "hard_churn_label boolean")
    assert S.class_weight(df).first()["weight"] == 2.0


def test_model_survives_saving(features, model, tmp_path):
    path = S.save_model(model, str(tmp_path / "m"))
    matrix = S.feature_matrix(features)
    one = {r["company_id"]: r["probability"] for r in S.score(model, matrix).collect()}
    two = {r["company_id"]: r["probability"] for r in S.score(S.load_model(path), matrix).collect()}
    assert one == two and isinstance(S.load_model(path), PipelineModel)


def test_a_batch_with_other_categories_scores_as_in_the_whole_table(spark, features, model):
    whole = {r["company_id"]: r["probability"] for r in S.score(model, S.feature_matrix(features)).collect()}
    batch = S.feature_matrix(features.where("industry = 'Tech'"))
    part = {r["company_id"]: r["probability"] for r in S.score(model, batch).collect()}
    assert part and all(whole[k] == p for k, p in part.items())
    unknown = features.withColumn("industry", F.when(F.col("company_id") > "", F.lit(None).cast("string")))
    rows = S.score(model, S.feature_matrix(unknown)).collect()
    assert len(rows) == len(whole) and all(0 <= r["probability"] <= 1 for r in rows)


def test_attributions_add_up_to_the_margin(spark, features, model):
    matrix = S.feature_matrix(features)
    probability = {r["company_id"]: r["probability"] for r in S.score(model, matrix).collect()}
    for r in A.attribution(model, matrix).collect():
        p = probability[r["company_id"]]
        assert r["margin"] == pytest.approx(np.log(p / (1 - p)), abs=1e-9)
        assert sum(r[c] for c in S.FEATURES) + r["base_value"] == pytest.approx(r["margin"])
    top = A.top_features(A.feature_importance(A.attribution(model, matrix)), 3).collect()
    assert len(top) == 3 and top[0][1] >= top[1][1] >= top[2][1]


def test_attribution_is_the_shapley_value():
    rng = np.random.default_rng(1)
    inf = np.inf
    forest = [
        A.Leaf(2.0, [A.PathFeature(0, -inf, 0.5, 0.3), A.PathFeature(1, 0.2, inf, 0.6)]),
        A.Leaf(-1.0, [A.PathFeature(0, 0.5, inf, 0.7), A.PathFeature(2, -inf, 0.4, 0.5), A.PathFeature(1, 0.1, 0.9, 0.4)]),
        A.Leaf(0.5, [A.PathFeature(2, 0.4, inf, 0.5)]),
    ]
    x = rng.random((6, 3))

    def game(row, known):
        total = 0.0
        for leaf in forest:
            part = leaf.value
            for f in leaf.features:
                part *= float(f.low < row[f.index] <= f.high) if f.index in known else f.share
            total += part
        return total

    got = A.attribute_batch(x, forest)
    for row, values in zip(x, got):
        for i in range(3):
            others = [j for j in range(3) if j != i]
            want = sum(
                factorial(k) * factorial(2 - k) / 6 * (game(row, {*s, i}) - game(row, set(s)))
                for k in range(3)
                for s in combinations(others, k)
            )
            assert values[i] == pytest.approx(want)


def test_cross_validation_runs(features):
    row = S.cross_validate(features, folds=3, trees=2).first()
    assert row["folds"] == 3 and 0.5 < row["mean_auc"] <= 1.0 and row["std_auc"] >= 0


def risk(rows):
    return rows.withColumn(
        "probability",
        F.least(F.lit(1.0), F.col("avg_ttft_ms_onboarding") / 20.0 + F.col("count_429_onboarding") / 40.0),
    )


def test_scenarios_against_a_loop(features):
    matrix = features.fillna(0)
    rows = matrix.collect()

    def p(r, ttft, rl):
        return min(1.0, r["avg_ttft_ms_onboarding"] * ttft / 20.0 + r["count_429_onboarding"] * (1 - rl) / 40.0)

    got = W.counterfactual_scenarios(matrix, risk).collect()
    assert [r["scenario"] for r in got] == [s.name for s in W.SCENARIOS]
    assert [r["ttft_reduction_pct"] for r in got] == [0, 25, 50, 0, 50]
    for r, s in zip(got, W.SCENARIOS):
        saved = [x for x in rows if p(x, 1, 0) >= 0.75 and p(x, s.ttft_mult, s.rl_red) < 0.75]
        assert r["accounts_moved_to_safe"] == len(saved)
        assert r["estimated_arr_retained"] == sum(120000 if x["contract_tier"] == "Enterprise" else 24000 for x in saved)
    assert got[0]["accounts_moved_to_safe"] == 0
    one = W.what_if(matrix, risk, 50, 100).first()
    assert one["accounts_moved_to_safe"] == got[4]["accounts_moved_to_safe"]
    assert W.saved_accounts(matrix, risk, 50, 100).count() == one["accounts_moved_to_safe"]


def test_scenarios_with_a_trained_model(features, model):
    matrix = S.feature_matrix(features)
    got = W.counterfactual_scenarios(matrix, lambda rows: S.score(model, rows)).collect()
    assert got[0]["accounts_moved_to_safe"] == 0 and len(got) == 5


def test_perturbation_goes_by_name(spark):
    df = spark.createDataFrame([(2.0, 4, 8.0)], "avg_ttft_ms double, count_429_onboarding int, other double")
    row = W.perturb_features(df, 0.5, 0.25).first()
    assert (row[0], row[1], row[2]) == (1.0, 3.0, 8.0)
