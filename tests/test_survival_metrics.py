import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from usagetide.operators import causal as C
from usagetide.operators import metrics as Q
from usagetide.operators import survival as V


def frame(spark, rows):
    return spark.createDataFrame(rows, "t int, e int, is_treatment boolean")


def test_km_curve_by_hand(spark):
    # Event and censoring share a day; the last account ends by an event.
    rows = [(2, 1, True), (2, 0, True), (3, 1, True), (5, 1, True)]
    got = {r["t"]: r for r in V.km_curve(frame(spark, rows), "t", "e").collect()}
    assert sorted(got) == [0, 2, 3, 5]
    assert got[0]["survival"] == 1.0 and got[0]["at_risk"] == 4
    assert got[2]["survival"] == pytest.approx(0.75) and got[2]["censored"] == 1
    assert got[3]["survival"] == pytest.approx(0.375)
    assert got[5]["survival"] == 0.0


def test_km_without_events_and_negative_days(spark):
    rows = [(-3, 1, True), (4, 0, True), (90, 0, False), (90, 0, False)]
    curve = V.km_curve(frame(spark, rows), "t", "e")
    got = {(r["grp"], r["t"]): r["survival"] for r in curve.collect()}
    assert got[(True, -3)] == pytest.approx(0.5) and got[(True, 0)] == pytest.approx(0.5)
    assert got[(False, 90)] == 1.0
    medians = {r["grp"]: r["median_days"] for r in V.km_median(curve).collect()}
    assert medians == {True: -3, False: None}


def test_confidence_band(spark):
    rows = [(d, 1, True) for d in range(1, 6)] + [(9, 0, True)] * 5
    band = {r["t"]: r for r in V.km_confidence(V.km_curve(frame(spark, rows), "t", "e")).collect()}
    s = 0.9
    se = math.sqrt(1 / (10 * 9))
    low = math.exp(-math.exp(math.log(-math.log(s)) + V.Z_95 * se / -math.log(s)))
    assert band[1]["lower_95"] == pytest.approx(low)
    assert band[0]["lower_95"] == band[0]["upper_95"] == 1.0
    assert all(r["lower_95"] <= r["survival"] <= r["upper_95"] for r in band.values())


def test_logrank_by_hand(spark):
    rows = [(1, 1, True), (3, 1, True), (2, 1, False), (4, 0, False)]
    got = V.logrank_test(frame(spark, rows), "t", "e").first()
    # Expected treated events: 2/4 + 1/3 + 1/2; variances 1/4 + 2/9 + 1/4.
    assert got["observed"] == 2
    assert got["expected"] == pytest.approx(1 / 2 + 1 / 3 + 1 / 2)
    chi2 = (2 - 4 / 3) ** 2 / (1 / 4 + 2 / 9 + 1 / 4)
    assert got["chi2"] == pytest.approx(chi2)
    assert got["p_value"] == pytest.approx(math.erfc(math.sqrt(chi2 / 2)))


def test_chi_square_tail(spark):
    xs = [0.0, 1e-6, 0.3, 3.84, 5.99, 6.01, 25.0, 200.0]
    df = spark.createDataFrame([(x,) for x in xs] + [(None,)], "x double")
    got = [r[0] for r in df.select(V.chi2_tail_1df(df.x)).collect()]
    assert got[-1] is None
    for x, p in zip(xs, got):
        assert p == pytest.approx(math.erfc(math.sqrt(x / 2)), rel=1e-9)


def test_propensity_is_the_penalised_fit(spark):
    rng = np.random.default_rng(3)
    n = 80
    industry = rng.choice(["A", "B", "C"], n)
    tokens, growth = rng.integers(0, 5000, n), rng.random(n)
    treated = rng.random(n) < 1 / (1 + np.exp(-(growth * 3 - 1.5)))
    tier = rng.choice(["Enterprise", "Growth"], n)
    rows = [
        (i, str(industry[i]), str(tier[i]), float(tokens[i]), float(growth[i]), bool(treated[i])) for i in range(n)
    ]
    df = spark.createDataFrame(
        rows,
        "company_id int, industry string, contract_tier string, avg_tokens_days_0_14 double, "
        "growth_rate double, is_treatment boolean",
    )
    x = np.column_stack(
        [tier == "Enterprise", np.log1p(tokens), growth, *[industry == v for v in ("A", "B", "C")]]
    ).astype(float)
    x = (x - x.mean(0)) / x.std(0)
    x = np.column_stack([np.ones(n), x])
    penalty = np.diag([0.0] + [1.0] * 6)
    w = np.zeros(7)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve(x.T * (p * (1 - p)) @ x + penalty, x.T @ (p - treated) + penalty @ w)
    want = 1 / (1 + np.exp(-x @ w))
    for r in C.propensity_score(df).collect():
        assert r["propensity_score"] == pytest.approx(want[r["company_id"]], abs=1e-4)


def test_smd(spark):
    rows = [(True, 1.0, 5.0), (True, 3.0, 5.0), (False, 0.0, 5.0), (False, 2.0, 5.0)]
    df = spark.createDataFrame(rows, "is_treatment boolean, x double, flat double")
    got = {r["covariate"]: r["smd"] for r in C.smd(df, ["x", "flat"]).collect()}
    assert got["x"] == pytest.approx(1 / math.sqrt(2)) and got["flat"] == 0.0


@pytest.mark.parametrize("range_rows", [1000, 5])
def test_ranking_metrics(spark, range_rows):
    rng = random.Random(4)
    rows = [(rng.randrange(30) / 30, int(rng.random() < 0.4)) for _ in range(200)]
    df = spark.createDataFrame(rows, "s double, y int")
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert Q.roc_auc(df, "s", "y", range_rows).first()[0] == pytest.approx(auc)
    ap = 0.0
    for s in sorted(set(s for s, _ in rows), reverse=True):
        hit = [y for x, y in rows if x >= s]
        ap += sum(1 for x, y in rows if x == s and y) / len(pos) * sum(hit) / len(hit)
    assert Q.average_precision(df, "s", "y", range_rows).first()[0] == pytest.approx(ap)
    points = Q.roc_pr_curves(df, "s", "y", range_rows).orderBy("threshold").collect()
    assert points[0]["tpr"] == points[0]["fpr"] == 1.0
    assert len(points) == len(set(s for s, _ in rows))


def test_report_without_positives(spark):
    df = spark.createDataFrame([(0.1, 0), (0.9, 0)], "s double, y int")
    got = {r["class"]: r for r in Q.classification_report(df, "s", "y").collect()}
    assert got["Churn"]["recall"] == 0.0 and got["Churn"]["support"] == 0
    assert got["accuracy"]["f1"] == 0.5


def test_newton_equals_the_gradient_method_at_the_optimum(spark):
    rng = random.Random(9)
    rows = []
    for i in range(300):
        x = [rng.gauss(0, 1), rng.random(), float(i % 3 == 0)]
        rows.append((i, rng.random() < 1 / (1 + math.exp(-x[0] + x[1])), *x))
    df = spark.createDataFrame(rows, "company_id long, is_treatment boolean, a double, `b c` double, d double")
    names = ["a", "b c", "d"]
    for penalty_c in (0.05, 1.0, 50.0):
        beta = C.newton_propensity(df, names, penalty_c)
        model = C.fit_propensity(df.withColumnRenamed("b c", "b"), ["a", "b", "d"], 300, penalty_c)
        assert list(beta) == pytest.approx([model.intercept, *model.coefficients], abs=1e-5)
        worst = max(abs(r.gradient) for r in C.propensity_gradient(df, names, beta, penalty_c).collect())
        assert worst < 1e-9
    one_class = df.withColumn("is_treatment", F.lit(True))
    assert list(C.newton_propensity(one_class, names)) == [0.0] * 4
    # Separated classes: finite coefficients all the same.
    apart = df.withColumn("is_treatment", F.col("a") > 0)
    beta = C.newton_propensity(apart, names)
    assert max(abs(r.gradient) for r in C.propensity_gradient(apart, names, beta).collect()) < 1e-8
