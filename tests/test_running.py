import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from usagetide.functions.running import exact_quantiles, hash_ranks, running_totals


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("range_rows", [1000, 7])
def test_running_totals(spark, descending, range_rows):
    rng = random.Random(1)
    rows = [(g, float(x), rng.randrange(9)) for g in (0, 1) for x in rng.sample(range(500), 60)]
    df = spark.createDataFrame(rows, "g int, x double, n long")
    got = {
        (r["g"], r["x"]): r["cum_n"]
        for r in running_totals(df, "x", ["n"], ["g"], descending, range_rows).collect()
    }
    for g in (0, 1):
        total = 0
        for _, x, n in sorted((r for r in rows if r[0] == g), key=lambda r: r[1], reverse=descending):
            total += n
            assert got[(g, x)] == total


@pytest.mark.parametrize("range_rows", [1000, 9])
def test_exact_quantiles_match_numpy(spark, range_rows):
    rng = random.Random(2)
    rows = [(g, rng.randrange(40) / 40) for g in (0, 1) for _ in range(101 + g)]
    df = spark.createDataFrame(rows, "g int, v double")
    for r in exact_quantiles(df, "v", [0.25, 0.5, 0.75], ["g"], range_rows).collect():
        values = [v for g, v in rows if g == r["g"]]
        for q in (25, 50, 75):
            assert r[f"q_{q}"] == pytest.approx(np.percentile(values, q))
    whole = exact_quantiles(df, "v", [0.5], range_rows=range_rows).first()
    assert whole["q_50"] == pytest.approx(np.median([v for _, v in rows]))


def test_hash_ranks_are_a_permutation_per_group(spark):
    df = spark.range(300).select("id", (F.col("id") % 3 == 0).alias("label"))
    rows = hash_ranks(df, "id", 42, ["label"], range_rows=10).collect()
    for label, n in ((True, 100), (False, 200)):
        ranks = sorted(r["hash_rank"] for r in rows if r["label"] == label)
        assert ranks == list(range(1, n + 1))
        assert {r["group_rows"] for r in rows if r["label"] == label} == {n}


def test_metrics_ignore_scores_without_a_value_at_every_size(spark):
    from usagetide.operators import metrics

    nan = float("nan")
    rows = [(0.1, 0), (0.2, 0), (0.2, 1), (0.4, 1), (0.5, 0), (0.9, 1), (None, 1), (None, 0), (nan, 1), (nan, 0)]
    df = spark.createDataFrame([(s, bool(y)) for s, y in rows], "score double, label boolean")
    plain = [(s, y) for s, y in rows if s is not None and s == s]
    wins = sum((a > b) + 0.5 * (a == b) for a, y in plain if y for b, z in plain if not z)
    pairs = sum(y for _, y in plain) * sum(1 - y for _, y in plain)
    for size in (2, 200_000):
        assert abs(metrics.roc_auc(df, "score", "label", size).first()[0] - wins / pairs) < 1e-12
        assert metrics.roc_pr_curves(df, "score", "label", size).count() == 5
    one, two = (metrics.average_precision(df, "score", "label", size).first()[0] for size in (2, 200_000))
    assert abs(one - two) < 1e-12


def test_rules_treat_nan_as_missing(spark):
    from usagetide.functions import business

    df = spark.sql("SELECT 0 AS count_429_onboarding, double('NaN') AS avg_ttft_ms_onboarding, double('NaN') AS max_context_saturation_onboarding,"
                   " 0 AS count_500_onboarding, 0 AS count_503_onboarding, 0.5D AS avg_cache_ratio_onboarding")
    assert df.select(business.prescribe().alias("p")).first().p.top_friction_trigger == "Declining velocity"
