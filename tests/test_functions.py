import random

import pytest
from pyspark.sql import functions as F

from usagetide.functions import business as B
from usagetide.functions.numeric import equal_width_bin, exact_avg, exact_slope, ratio, round_to
from usagetide.operators.scoring import prescribe


def values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_round_to_scales_then_rounds(spark):
    assert values(spark, round_to("x", 2), [(1.005,), (2.5,), (-2.675,)], "x double") == [1.0, 2.5, -2.68]
    assert values(spark, round_to("x", 0), [(2.5,), (-2.5,)], "x double") == [3.0, -3.0]


def test_ratios_are_null_safe(spark):
    rows = [(1, 0), (1, None), (None, 2), (1, 4)]
    assert values(spark, ratio("a", "b"), rows, "a int, b int") == [None, None, None, 0.25]
    assert values(spark, B.cache_ratio("a", "b"), rows, "a int, b int") == [None, None, None, 0.25]
    assert values(spark, B.pct_change("a", "b"), rows, "a int, b int") == [None, None, None, -75.0]


def test_day_bins_are_left_closed(spark):
    days = [-1, 0, 13, 14, 27, 28, 69, 70, 89, 90]
    want = [None, "Days 0-14", "Days 0-14", "Days 15-28", "Days 15-28", "Days 29-42", "Days 57-70", "Days 71-90"]
    assert values(spark, B.day_bin("d"), [(d,) for d in days], "d int") == [*want, "Days 71-90", None]


def test_risk_tiers_are_right_closed(spark):
    got = values(spark, B.risk_tier("p"), [(p,) for p in (0.0, 0.5, 0.51, 0.75, 0.76, 0.85, 0.86, 1.0)], "p double")
    assert got == ["Low", "Low", "Medium", "Medium", "High", "High", "Critical", "Critical"]


def test_onboarding_has_no_lower_bound(spark):
    rows = [("2023-12-01",), ("2024-01-14",), ("2024-01-15",)]
    flag = B.onboarding_flag(F.to_date("d"), F.lit("2024-01-01").cast("date"))
    assert values(spark, flag, rows, "d string") == [True, True, False]


def test_friction_bucket(spark):
    rows = [(0.55, 400.0), (0.55, 399.0), (0.55, None), (0.54, 900.0)]
    assert values(spark, B.friction_bucket("s", "t"), rows, "s double, t double") == ["Severe", "Mild", "Mild", "None"]


def test_first_rule_wins(spark):
    schema = (
        "count_429_onboarding int, avg_ttft_ms_onboarding double, max_context_saturation_onboarding double, "
        "count_500_onboarding int, count_503_onboarding int, avg_cache_ratio_onboarding double"
    )
    rows = [
        (3, 500.0, 0.95, 2, 2, 0.0),
        (2, 400.0, 0.95, 0, 0, 0.5),
        (2, None, 0.90, 0, 0, 0.5),
        (0, 1.0, 0.1, 1, 2, 0.5),
        (0, 1.0, 0.1, 0, 0, 0.09),
        (0, 1.0, 0.1, 0, 0, 0.10),
        (None, None, None, None, None, None),
    ]
    got = [r["top_friction_trigger"] for r in prescribe(spark.createDataFrame(rows, schema)).collect()]
    assert got == [rule.trigger for rule in B.RULES] + [B.DEFAULT_RULE.trigger] * 2


def test_arr_value_default(spark):
    rows = [("Enterprise",), ("Growth",), ("Other",), (None,)]
    assert values(spark, B.arr_value("t"), rows, "t string") == [120000, 24000, 24000, 24000]
    assert values(spark, B.arr_value("t", default=None), rows, "t string") == [120000, 24000, None, None]


def test_bins(spark):
    low, high = F.lit(0.0), F.lit(10.0)
    rows = [(0.0,), (4.9,), (5.0,), (10.0,)]
    assert values(spark, equal_width_bin(F.col("x"), low, high, 2), rows, "x double") == [0, 0, 1, 1]
    assert values(spark, equal_width_bin(F.col("x"), F.lit(3.0), F.lit(3.0), 4), [(3.0,)], "x double") == [2]


def test_exact_aggregates(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(10**6) / 100, rng.randrange(14), rng.randrange(10**6)) for _ in range(500)]
    df = spark.createDataFrame(rows, "v double, x int, y long")
    first = df.agg(exact_avg(F.col("v"), 2)).first()[0]
    assert first == df.repartition(17).agg(exact_avg(F.col("v"), 2)).first()[0]
    assert first == pytest.approx(sum(r[0] for r in rows) / len(rows))
    got = df.agg(exact_slope(F.col("y"), F.col("x"), F.lit(True)).alias("a"), F.regr_slope("y", "x").alias("b")).first()
    assert got["a"] == pytest.approx(got["b"])
    one = df.where("x = 3").agg(exact_slope(F.col("y"), F.col("x"), F.lit(True))).first()[0]
    assert one is None


def test_display_strings(spark):
    assert values(spark, B.risk_badge("p"), [(0.85,), (0.75,), (0.6,)], "p double") == ["🔴 0.85", "🟠 0.75", "🟡 0.60"]
    assert values(spark, B.milliseconds_text("p"), [(412.4,)], "p double") == ["412 ms"]
    assert values(spark, B.money_text("p"), [(1392000,)], "p long") == ["$1,392,000"]
