"""Spark against DuckDB on shared tables, plain and with one customer holding a third of the events."""

import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import compare  # noqa: E402

SMALL = "/root/testdata/sf0.001"
PLAIN = ["heatmap_finding_90", "account_card_one", "logrank_test_matched_soft", "propensity_score_certificate", "fct_account_features", "int_cohort_health", "caliper_match", "km_confidence_soft", "scored_accounts"]
SKEWED = ["int_usage_velocity", "fct_cohort_churn", "errors_join_signup_day", "account_429_daily", "match_summary"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="shared test tables not present")


def connect(folder):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in sorted(os.listdir(folder)):
        path = f"{folder}/{name}"
        path = path + "/*.parquet" if os.path.isdir(path) else path
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}')")
    return connection


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    hot = events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id")))
    hot.write.parquet(f"{folder}/events.parquet")
    spark.read.parquet(f"{SMALL}/customer.parquet").write.parquet(f"{folder}/customer.parquet")
    return folder


def test_every_query_has_a_counterpart_or_is_known_not_to():
    model_bound = {
        "save_load_model", "top_features", "propensity_score", "train_churn_model", "cross_validate", "attribution"
    }
    own = {n for n in entry.queries() if n != "pipeline" and not n.startswith("op")}
    fitted = {n for n in own if n.startswith(("holdout_", "model_", "fitted_")) or "_fitted_" in n}
    assert own - set(entry.oracle_sql()) == model_bound | fitted
    # Each fit has a certificate that SQL knows.
    assert {f"{n}_certificate" for n in model_bound} <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", PLAIN)
def test_plain(spark, name):
    assert compare(spark, connect(SMALL), name, SMALL, entry.oracle_sql()[name]) == ""


@pytest.mark.parametrize("name", SKEWED)
def test_skewed(spark, skewed, name):
    assert compare(spark, connect(skewed), name, skewed, entry.oracle_sql()[name]) == ""


def test_late_days_are_filled(spark):
    row = entry.queries()["heatmap_finding_90"](spark, SMALL).first()
    assert row.severe_drop_pct is not None and row.none_growth_pct is not None


def test_metrics_over_stored_scores(spark, tmp_path, monkeypatch):
    """Metrics of a fitted model's hold-out, by DuckDB from its stored scores."""
    from usagetide.operators import boosting, metrics, scoring
    from usagetide.registry import oracle
    from usagetide.registry.queries import inputs

    i = inputs(spark, "/root/testdata/sf0.01")
    forest = boosting.train(i.features, boosting.Settings(trees=5))
    path = str(tmp_path / "scores")
    boosting.holdout(i.features, forest).write.parquet(path)
    scores = spark.read.parquet(path)
    n = {r[0]: r[1] for r in scoring.stratified_split(i.features).where("is_test").groupBy("hard_churn_label").count().collect()}
    assert {r.label: r["count"] for r in scores.groupBy("label").count().collect()} == {int(k): v for k, v in n.items()}
    monkeypatch.setitem(
        oracle.RELATIONS, "scored", f"SELECT probability AS churn_probability, label AS hard_churn_label FROM read_parquet('{path}/*.parquet')"
    )
    connection = duckdb.connect()
    for name in ("roc_auc", "average_precision", "roc_pr_curves", "classification_report", "confusion_matrix"):
        got = getattr(metrics, name)(scores, "probability", "label")
        result = connection.execute(oracle.with_relations(oracle.BODIES[name]))
        columns = [d[0] for d in result.description]
        rows = [sorted((tuple(r) for r in side), key=str) for side in (got.select(*columns).collect(), result.fetchall())]
        assert len(rows[0]) == len(rows[1])
        for mine, theirs in zip(*rows):
            assert mine == pytest.approx(theirs, abs=1e-6) if not isinstance(mine[0], str) else mine[1:] == pytest.approx(theirs[1:], abs=1e-6), name
