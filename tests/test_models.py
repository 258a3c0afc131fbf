import datetime as dt

import pytest

from usagetide.operators import quality as K
from usagetide.plans import models as M
from usagetide.plans.pipeline import Pipeline
from usagetide.sources.schemas import API_ERRORS, COMPANIES, DAILY_USAGE

START = dt.date(2024, 1, 1)


def day(n):
    return START + dt.timedelta(days=n)


def pipeline(spark, series, errors=(), risk=0.6, horizon=90, signup=0):
    """One company per token series; ``series[id]`` lists (day, tokens)."""
    companies = [(c, f"Co {c}", "Tech", "Growth", day(signup), 0.5, risk) for c in series]
    usage = [
        (f"{c}-{d}", day(d), c, tokens, 0, 0, 450.0, 0.5) for c, rows in series.items() for d, tokens in rows
    ]
    return Pipeline(
        spark.createDataFrame(companies, COMPANIES),
        spark.createDataFrame(usage, DAILY_USAGE),
        spark.createDataFrame(list(errors), API_ERRORS),
        horizon=horizon,
    )


def labels(spark, rows, **kw):
    return pipeline(spark, {"a": rows}, **kw).fct_cohort_churn.first().asDict()


def test_frames_count_rows_not_days(spark):
    rows = [(2 * n, 100 * n) for n in range(9)]
    got = pipeline(spark, {"a": rows}).int_usage_velocity.orderBy("usage_date").collect()
    assert got[8]["rolling_7d_avg_tokens"] == 500.0
    assert got[8]["wow_pct_change"] == 700.0
    assert got[0]["dod_token_delta"] is None
    assert got[1]["dod_pct_change"] is None  # the day before had none
    assert got[2]["dod_pct_change"] == 100.0


def test_thresholds_are_inclusive(spark):
    # Rolling mean over rows: 1000 at first, then diluted by zeros.
    exactly = [(n, 1000 if n == 0 else 0) for n in range(6)]
    row = labels(spark, exactly)
    # 1000/2 = 500 at day 1 (<= 60 %), 1000/5 = 200 at day 4 (<= 20 %).
    assert (row["days_to_soft_decay"], row["days_to_hard_churn"]) == (1, 4)
    assert row["hard_churn_label"] and row["hard_churn_observed"] == 1


def test_drop_before_the_peak_does_not_count(spark):
    row = labels(spark, [(0, 1000), (1, 0), (2, 0), (3, 0), (4, 50000)])
    assert row["peak_date"] == day(4)
    assert not row["hard_churn_label"] and row["days_to_hard_churn"] == 90


def test_first_of_equal_peaks(spark):
    rows = [(n, 700) for n in range(4)]
    p = pipeline(spark, {"a": rows})
    assert p.fct_cohort_churn.first()["peak_date"] == day(0)
    assert M.first_peak_date(p.int_usage_velocity).first()["peak_date"] == day(0)


def test_zero_peak_never_churns(spark):
    row = labels(spark, [(n, 0) for n in range(10)])
    assert not row["hard_churn_label"] and not row["soft_decay_label"]


def test_days_before_signup_stay(spark):
    p = pipeline(spark, {"a": [(n, 10) for n in range(12)]}, signup=8)
    weeks = [r["week_num"] for r in p.int_cohort_health.collect()]
    assert weeks == [-2, -1, 0]
    assert p.int_friction_flags.first()["onboarding_days_active"] == 12


def test_company_without_onboarding_rows_is_left_out(spark):
    p = pipeline(spark, {"a": [(20, 5)], "b": [(0, 5)]})
    assert [r["company_id"] for r in p.fct_account_features.collect()] == ["b"]
    assert p.int_friction_flags.count() == 1


def test_error_counts_and_missing_errors(spark):
    at = dt.datetime(2024, 1, 3, 5)
    late = dt.datetime(2024, 2, 3, 5)
    errors = [("e1", at, "a", 429, "/x"), ("e2", at, "a", 429, "/x"), ("e3", at, "a", 503, "/x"), ("e4", late, "a", 500, "/x")]
    p = pipeline(spark, {"a": [(0, 5)], "b": [(0, 5)]}, errors)
    got = {r["company_id"]: r for r in p.int_friction_flags.collect()}
    assert got["a"]["count_429_onboarding"] == 2 and got["a"]["total_errors_onboarding"] == 3
    assert got["b"]["total_errors_onboarding"] == 0
    assert got["a"]["friction_bucket"] == "Severe"
    feature = {r["company_id"]: r for r in p.fct_account_features.collect()}
    assert feature["a"]["count_503_onboarding"] == 1


def test_rollup_agrees_with_single_models(spark):
    series = {c: [(n, (n * k) % 97) for n in range(40)] for k, c in ((7, "a"), (31, "b"))}
    p = pipeline(spark, series)
    onset = {r["company_id"]: r for r in M.churn_onset(p.int_usage_velocity).collect()}
    trend = {r["company_id"]: r for r in M.velocity_trends(p.int_usage_velocity).collect()}
    for r in p.fct_account_features.collect():
        hard = onset[r["company_id"]]["hard_churn_date"]
        assert r["days_to_hard_churn"] == ((hard - START).days if hard else 90)
        assert r["avg_tokens_days_15_30"] == trend[r["company_id"]]["avg_tokens_days_15_30"]


def test_usage_is_shuffled_once_for_the_feature_table(spark):
    p = pipeline(spark, {"a": [(0, 5)]})
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        plan = p.fct_account_features.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    # Usage once, companies for usage and for errors, errors before and after counting.
    assert plan.count("Exchange hashpartitioning") <= 5
    assert "BroadcastExchange" not in plan and "CartesianProduct" not in plan


def test_quality_checks(spark):
    p = pipeline(spark, {"a": [(0, 5)], "b": [(0, 5)]})
    churn, features = p.fct_cohort_churn, p.fct_account_features
    report = K.quality_report(
        K.check_unique_company(churn.union(churn)),
        K.check_exclusive_groups(churn),
        K.check_rowcount(features.where("company_id = 'a'"), p.companies),
        K.check_not_null(churn),
        K.check_unique_company_day(p.usage.union(p.usage.where("company_id = 'a'"))),
        K.orphan_check(p.usage, p.companies.where("company_id = 'b'")),
    )
    assert [r["violations"] for r in report.collect()] == [2, 0, 1, 0, 1, 1]
    assert [r["status"] for r in report.collect()] == ["FAIL", "PASS", "FAIL", "PASS", "FAIL", "FAIL"]


def test_horizon_is_the_censoring_day(spark):
    row = labels(spark, [(n, 7) for n in range(5)], horizon=30)
    assert row["days_to_hard_churn"] == 30 and row["hard_churn_observed"] == 0


@pytest.mark.parametrize("n", [1, 13])
def test_slope(spark, n):
    got = pipeline(spark, {"a": [(d, 10 + 3 * d) for d in range(n)]}).fct_account_features.first()
    assert got["token_growth_slope_onboarding"] == (None if n == 1 else 3.0)
