"""Bucketed models, checks observed while writing, refresh of changed days, publication and quarantine."""

import datetime as dt
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from usagetide.operators import quality as K
from usagetide.plans import models as M
from usagetide.plans import refresh as R
from usagetide.plans.pipeline import Pipeline
from usagetide.sources import readers, sinks
from usagetide.sources.schemas import API_ERRORS, COMPANIES, DAILY_USAGE

DAY = dt.date(2024, 1, 1)


def companies_of(spark, n=25):
    rows = [(f"c{i:02d}", f"Co {i}", ("Tech", "Legal")[i % 2], ("Growth", "Enterprise")[i % 2], DAY + dt.timedelta(i % 5), 0.1 * (i % 7), (i % 10) / 10) for i in range(n)]
    return spark.createDataFrame(rows, COMPANIES)


def usage_row(i, d, x):
    return (f"l{i}-{d}", DAY + dt.timedelta(d), f"c{i:02d}", x, x // 2, x // 3, float(x % 900), (x % 100) / 100)


def usage_of(spark, n=25, days=40, seed=1):
    rng = random.Random(seed)
    rows = [usage_row(i, d, rng.randrange(1, 5000)) for i in range(n) for d in range(days) if rng.random() < 0.7]
    return spark.createDataFrame(rows, DAILY_USAGE)


def errors_of(spark, n=25):
    rng = random.Random(2)
    rows = [(f"e{k}", dt.datetime(2024, 1, 1 + rng.randrange(28), 10), f"c{rng.randrange(n):02d}", rng.choice(M.ERROR_CODES), "/v1/messages") for k in range(300)]
    return spark.createDataFrame(rows, API_ERRORS)


@pytest.fixture(scope="module")
def pipe(spark):
    return Pipeline(companies_of(spark), usage_of(spark), errors_of(spark))


@pytest.fixture(scope="module")
def stored(pipe, tmp_path_factory):
    return pipe.persist(str(tmp_path_factory.mktemp("models")), buckets=3)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stored_models_equal_the_plans(pipe, stored):
    for name, model in pipe.models().items():
        back = stored.models()[name]
        assert back.columns == model.columns and rows(back) == rows(model), name


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_models_need_no_exchange_on_the_company(spark, pipe, stored):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        built = {
            "cohort": M.int_cohort_health(stored.int_usage_velocity, sort=False),
            "rollup": M.account_rollup(stored.int_usage_velocity),
            "churn": M.fct_cohort_churn(stored.account_rollup, stored.onboarding_errors),
            "features": M.fct_account_features(stored.account_rollup, stored.onboarding_errors),
            "friction": M.friction_flags(stored.stg_daily_usage, stored.onboarding_errors),
            "velocity": M.int_usage_velocity(stored.stg_daily_usage),
        }
        for name, model in built.items():
            assert not re.search(r"Exchange hashpartitioning\(company_id", plan_of(model)), name
        assert "Exchange hashpartitioning(company_id" in plan_of(M.int_cohort_health(pipe.int_usage_velocity, sort=False))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_observed_report_equals_the_checks(pipe, stored):
    plain = K.quality_report(
        K.check_unique_company(pipe.fct_cohort_churn), K.check_exclusive_groups(pipe.fct_cohort_churn),
        K.check_rowcount(pipe.fct_account_features, pipe.companies), K.check_not_null(pipe.fct_cohort_churn),
        K.check_unique_company_day(pipe.usage), K.orphan_check(pipe.usage, pipe.companies),
    )
    seen = K.observed_report(stored.seen, stored.fct_cohort_churn, pipe.companies, pipe.usage)
    assert rows(seen) == rows(plain) and all(r.status == "PASS" for r in seen.collect())


def test_checks_find_known_violations(spark, pipe, stored):
    """A faulty copy: every check has violations, and both ways count them alike."""
    churn = pipe.fct_cohort_churn
    bad = churn.withColumn("is_control", F.lit(True))
    bad = bad.withColumn("hard_churn_label", F.when(F.col("company_id") < "c03", F.lit(None)).otherwise(F.col("hard_churn_label")))
    bad = bad.unionByName(bad.where("company_id < 'c02'"))
    usage = pipe.usage.unionByName(pipe.usage.where("company_id = 'c05'")).unionByName(
        pipe.usage.where("company_id = 'c06'").withColumn("company_id", F.lit("nobody"))
    )
    features = pipe.fct_account_features.where("company_id > 'c00'")
    written, seen = sinks.observed(bad, "bad", rows=F.count(F.lit(1)), no_label=F.count_if(F.col("hard_churn_label").isNull()),
                                   both_groups=F.count_if(F.col("is_treatment") & F.col("is_control")))
    written.write.format("noop").mode("overwrite").save()
    report = K.observed_report({"churn": seen.get, "features": {"rows": features.count()}}, bad, pipe.companies, usage)
    plain = K.quality_report(
        K.check_unique_company(bad), K.check_exclusive_groups(bad), K.check_rowcount(features, pipe.companies), K.check_not_null(bad),
        K.check_unique_company_day(usage), K.orphan_check(usage, pipe.companies),
    )
    assert rows(report) == rows(plain)
    assert all(r.violations > 0 and r.status == "FAIL" for r in report.collect())


# ---------------------------------------------------------------- refresh


def test_refresh_equals_a_full_rebuild(spark, tmp_path):
    companies, usage = companies_of(spark), usage_of(spark)
    folder, whole = str(tmp_path / "store"), str(tmp_path / "whole")
    R.build(usage.where(F.col("date") < F.lit(DAY + dt.timedelta(30))), companies, folder)
    rng = random.Random(4)
    # Ten appended days, corrections long ago, a late day that was missing, and an account not seen before.
    appended = usage.where(F.col("date") >= F.lit(DAY + dt.timedelta(30)))
    there = {(r.company_id, r.date) for r in usage.collect()}
    fixed = [usage_row(i, d, rng.randrange(1, 5000)) for i, d in ((3, 2), (3, 3), (7, 29), (9, 0), (11, 15))]
    missing = next((i, d) for i in range(25) for d in range(5, 20) if (f"c{i:02d}", DAY + dt.timedelta(d)) not in there)
    late = [usage_row(*missing, 77)]
    changed = appended.unionByName(spark.createDataFrame(fixed + late, DAILY_USAGE))
    keys = changed.select("company_id", "date")
    final = usage.join(keys, ["company_id", "date"], "left_anti").select(*usage.columns).unionByName(changed)
    untouched = f"{folder}/{R.VELOCITY}/usage_date={DAY + dt.timedelta(25)}"
    days = R.refresh(changed, companies, folder).collect()
    R.build(final, companies, whole)
    for read in (R.staged, R.velocity):
        columns = sorted(read(spark, whole).columns)
        assert rows(read(spark, folder).select(columns)) == rows(read(spark, whole).select(columns))
    assert os.path.isdir(untouched)
    again = R.refresh(changed, companies, folder)
    assert rows(R.velocity(spark, folder).select(columns)) == rows(R.velocity(spark, whole).select(columns)) and again.count() == len(days)


def test_refresh_writes_only_concerned_days(spark, tmp_path):
    companies, folder = companies_of(spark, 3), str(tmp_path / "store")
    rows_ = [usage_row(i, d, 10 * d + i + 1) for i in range(3) for d in range(40)]
    R.build(spark.createDataFrame(rows_, DAILY_USAGE), companies, folder)
    days = R.refresh(spark.createDataFrame([usage_row(1, 5, 9999)], DAILY_USAGE), companies, folder).collect()
    got = {m: sorted((r.usage_date - DAY).days for r in days if r.model == m) for m in (R.STAGED, R.VELOCITY)}
    assert got == {R.STAGED: [5], R.VELOCITY: list(range(5, 13))}
    assert R.refresh(spark.createDataFrame([], DAILY_USAGE), companies, folder).count() == 0


# ------------------------------------------------------------ publication


def test_a_failure_leaves_the_former_version(spark, tmp_path):
    folder = str(tmp_path / "results")
    with pytest.raises(FileNotFoundError):
        sinks.published(spark, folder, "a")
    sinks.publish_results({"a": spark.range(3), "b": spark.range(4)}, folder)
    broken = spark.range(9).select(F.raise_error(F.lit("stop")).cast("long").alias("id"))
    with pytest.raises(Exception):
        sinks.publish_results({"a": spark.range(7), "b": broken}, folder)
    assert (sinks.published(spark, folder, "a").count(), sinks.published(spark, folder, "b").count()) == (3, 4)
    sinks.publish_results({"a": spark.range(7), "b": spark.range(8)}, folder, "csv")
    assert sinks.published(spark, folder, "a", schema="id long").count() == 7
    assert sinks.published(spark, folder, "a", version=1).count() == 3
    with pytest.raises(FileNotFoundError):
        sinks.published(spark, folder, "a", version=5)


# ------------------------------------------------------------- quarantine


def test_bad_rows_are_set_aside(spark, tmp_path):
    head = "error_id,timestamp,company_id,error_code,endpoint\n"
    good = [f"e{k},2024-01-0{1 + k % 9} 10:00:00,c{k},429,/v1/messages" for k in range(20)]
    bad = ["x1,2024-01-01 10:00:00,c1,many,/v1", "x2,yesterday,c1,429,/v1", "x3,2024-01-01 10:00:00,c1,429,/v1,more", "x4,2024-01-01 10:00:00,c1"]
    (tmp_path / "one.csv").write_text(head + "\n".join([*good[:10], *bad[:2]]) + "\n")
    (tmp_path / "two.csv").write_text(head + "\n".join([*good[10:], *bad[2:], "e99,,c9,,/v1"]) + "\n")
    sifted = readers.sift_source(spark, str(tmp_path), API_ERRORS)
    assert sifted.good.count() == 21 and sifted.good.columns == API_ERRORS.fieldNames()
    found = {r.raw_record: (r.reason, os.path.basename(r.source_file)) for r in sifted.bad.collect()}
    assert found == {
        bad[0]: ("error_code is no int: many", "one.csv"), bad[1]: ("timestamp is no timestamp_ntz: yesterday", "one.csv"),
        bad[2]: ("too many fields", "two.csv"), bad[3]: ("too few fields", "two.csv"),
    }


def test_another_header_is_an_error(spark, tmp_path):
    path = tmp_path / "e.csv"
    path.write_text("error_id,company_id,timestamp,error_code,endpoint\ne,c,2024-01-01 10:00:00,429,/v1\n")
    with pytest.raises(Exception):
        readers.sift_source(spark, str(path), API_ERRORS)
    with pytest.raises(FileNotFoundError, match="api_errors"):
        readers.sift_sources(spark, {"api_errors": str(tmp_path / "none")})
