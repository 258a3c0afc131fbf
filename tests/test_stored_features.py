"""Queries of the fitted model, and the account cards, derive the feature table once and read it stored."""

import datetime as dt

import pytest

from usagetide.operators import boosting as G
from usagetide.registry import queries as R


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    customers = [(c, f"Co {c}", ("BUILDING", None)[c % 2], 900.0 * c) for c in range(1, 13)]
    spark.createDataFrame(customers, "c_custkey long, c_name string, c_mktsegment string, c_acctbal double").write.parquet(
        f"{path}/customer.parquet"
    )
    start = dt.datetime(2024, 1, 1)
    kinds = ("view", "click", "error")
    events = [
        (n, start + dt.timedelta(days=n % 30), 1 + n % 12, kinds[n % 3], float(n % 17 + 1) / (1 + n % 30 // 10), f'{{"k": {n * 7 % 100}}}')
        for n in range(720)
    ]
    spark.createDataFrame(events, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(
        f"{path}/events.parquet"
    )
    return path


@pytest.fixture
def inputs(spark, folder):
    found = R.inputs(spark, folder)
    found.once("model", lambda: G.train(found.stored_features, G.Settings(trees=2, depth=2)))
    return found


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


MODEL = ("train_churn_model", "save_load_model", "save_load_model_certificate", "attribution", "top_features", "model_portfolio_kpis",
         "model_scored_accounts", "holdout_roc_auc", "holdout_average_precision", "holdout_roc_pr_curves")


@pytest.mark.parametrize("name", [*MODEL, "account_card"])
def test_results_are_not_planned_from_the_sources_again(spark, folder, inputs, name):
    df = R.bind(name)(spark, folder)
    assert df.count() > 0
    assert "events.parquet" not in plan(df) and "props" not in plan(df)


def test_the_hold_out_reads_the_stored_table(spark, folder, inputs, monkeypatch):
    read = []
    monkeypatch.setattr(R.G, "holdout", lambda features, forest: read.append(plan(features)) or features)
    monkeypatch.setattr(R.G, "out_of_fold", lambda features: read.append(plan(features)) or features)
    for name in ("holdout", "out_of_fold"):
        R._fitted.pop((spark.sparkContext.applicationId, folder, name), None)
        getattr(inputs, name)
        R._fitted.pop((spark.sparkContext.applicationId, folder, name), None)
    assert len(read) == 2 and not any("props" in p for p in read)


def test_cards_equal_those_of_two_tables(spark, folder, inputs):
    want = R.P.account_card(inputs.scored, inputs.features)
    got = R.bind("account_card")(spark, folder)
    assert got.schema == want.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_stored_features_equal_the_lazy_ones(inputs):
    assert inputs.stored_features.schema == inputs.features.schema
    assert sorted(map(str, inputs.stored_features.collect())) == sorted(map(str, inputs.features.collect()))
