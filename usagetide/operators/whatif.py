"""Counterfactual scenarios: scale friction features, score again, compare."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import business as B
from ..functions.numeric import round_to

Scorer = Callable[[DataFrame], DataFrame]  # adds a double column "probability"


class Scenario(NamedTuple):
    name: str
    ttft_mult: float
    rl_red: float


# The pre-built scenarios.
SCENARIOS = [
    Scenario("Baseline (no change)", 1.0, 0.0),
    Scenario("TTFT reduced by 25%", 0.75, 0.0),
    Scenario("TTFT reduced by 50%", 0.50, 0.0),
    Scenario("Rate limits eliminated", 1.0, 1.0),
    Scenario("TTFT -50% + rate limits fixed", 0.50, 1.0),
]


def perturb_features(matrix: DataFrame, ttft_mult: Column | float, rl_red: Column | float) -> DataFrame:
    """Scale every latency column and every 429 column, found by name."""
    ttft = ttft_mult if isinstance(ttft_mult, Column) else F.lit(float(ttft_mult))
    limits = rl_red if isinstance(rl_red, Column) else F.lit(float(rl_red))
    scaled = {}
    for name in matrix.columns:
        factor = None
        if "ttft" in name.lower() and name != "ttft_mult":
            factor = ttft
        if "429" in name:
            factor = F.lit(1.0) - limits if factor is None else factor * (F.lit(1.0) - limits)
        if factor is not None:
            scaled[name] = F.col(name).cast("double") * factor
    return matrix.withColumns(scaled)


def scenario_cross(matrix: DataFrame, scenarios: Sequence[Scenario] = SCENARIOS) -> DataFrame:
    """Every account under every scenario.

    The scenarios are literals in the plan, so this is a map over the accounts
    with no join and no shuffle.
    """
    rows = [
        F.struct(
            F.lit(i).alias("scenario_no"),
            F.lit(s.name).alias("scenario"),
            F.lit(float(s.ttft_mult)).alias("ttft_mult"),
            F.lit(float(s.rl_red)).alias("rl_red"),
        )
        for i, s in enumerate(scenarios)
    ]
    crossed = matrix.select("*", F.inline(F.array(*rows)))
    return perturb_features(crossed, F.col("ttft_mult"), F.col("rl_red"))


def rescored(matrix: DataFrame, scorer: Scorer, scenarios: Sequence[Scenario]) -> DataFrame:
    """Accounts per scenario with ``baseline_risk`` and ``new_risk``.

    A scorer that knows what a scenario changes (``rescored``) is asked for the new risks itself.
    """
    if hasattr(scorer, "rescored"):
        return scorer.rescored(matrix, scenarios)
    base = scorer(matrix).withColumnRenamed("probability", "baseline_risk")
    return scorer(scenario_cross(base, scenarios)).withColumnRenamed("probability", "new_risk")


def _saved(threshold: float) -> Column:
    return (F.col("baseline_risk") >= F.lit(threshold)) & (F.col("new_risk") < F.lit(threshold))


def counterfactual_scenarios(
    matrix: DataFrame,
    scorer: Scorer,
    scenarios: Sequence[Scenario] = SCENARIOS,
    threshold: float = B.ALERT_THRESHOLD,
    values: Mapping[str, int] = B.ARR_BY_TIER,
    default_value: int = B.ARR_DEFAULT,
) -> DataFrame:
    """Accounts that fall below the threshold and their yearly value, per scenario."""
    saved = _saved(threshold)
    return (
        rescored(matrix, scorer, scenarios)
        .groupBy("scenario_no", "scenario", "ttft_mult", "rl_red")
        .agg(
            F.count_if(saved).alias("accounts_moved_to_safe"),
            F.sum(F.when(saved, B.arr_value("contract_tier", values, default_value)).otherwise(F.lit(0))).alias(
                "estimated_arr_retained"
            ),
        )
        .select(
            "scenario_no",
            "scenario",
            ((1.0 - F.col("ttft_mult")) * 100.0).cast("int").alias("ttft_reduction_pct"),
            (F.col("rl_red") * 100.0).cast("int").alias("rate_limit_reduction_pct"),
            "accounts_moved_to_safe",
            "estimated_arr_retained",
        )
        .orderBy("scenario_no")
    )


def _free_scenario(ttft_pct: float, rl_pct: float) -> list[Scenario]:
    return [Scenario("what-if", 1.0 - ttft_pct / 100.0, rl_pct / 100.0)]


def what_if(
    matrix: DataFrame,
    scorer: Scorer,
    ttft_pct: float = 50,
    rl_pct: float = 0,
    enterprise_value: int = B.ARR_BY_TIER["Enterprise"],
    growth_value: int = B.ARR_BY_TIER["Growth"],
    threshold: float = B.ALERT_THRESHOLD,
) -> DataFrame:
    """One row for freely chosen reductions and tier values."""
    values = {"Enterprise": enterprise_value, "Growth": growth_value}
    saved = _saved(threshold)
    return rescored(matrix, scorer, _free_scenario(ttft_pct, rl_pct)).agg(
        F.lit(int(ttft_pct)).alias("ttft_reduction_pct"),
        F.lit(int(rl_pct)).alias("rate_limit_reduction_pct"),
        F.count_if(F.col("baseline_risk") >= F.lit(threshold)).alias("n_high_risk"),
        F.count_if(saved).alias("accounts_moved_to_safe"),
        F.coalesce(F.sum(F.when(saved, B.arr_value("contract_tier", values, growth_value))), F.lit(0)).alias(
            "estimated_arr_retained"
        ),
    )


def saved_accounts(
    matrix: DataFrame,
    scorer: Scorer,
    ttft_pct: float = 50,
    rl_pct: float = 0,
    values: Mapping[str, int] = B.ARR_BY_TIER,
    threshold: float = B.ALERT_THRESHOLD,
    sort: bool = True,
) -> DataFrame:
    """Accounts moved to safe with both risks, the change and their value."""
    moved = rescored(matrix, scorer, _free_scenario(ttft_pct, rl_pct)).where(_saved(threshold))
    out = moved.select(
        "company_id",
        "company_name",
        "contract_tier",
        "industry",
        round_to("baseline_risk", 3).alias("baseline_risk"),
        round_to("new_risk", 3).alias("cf_risk"),
        round_to(F.col("baseline_risk") - F.col("new_risk"), 3).alias("risk_delta"),
        B.money_text(B.arr_value("contract_tier", values, None)).alias("arr_value"),
    )
    return out.orderBy(F.desc("baseline_risk"), "company_id") if sort else out


def risk_overlay(matrix: DataFrame, scorer: Scorer, ttft_pct: float = 50, rl_pct: float = 0) -> DataFrame:
    """Baseline and new risk as one long table for a before/after histogram."""
    pair = F.array(
        F.struct(F.lit("Baseline").alias("series"), F.col("baseline_risk").alias("risk")),
        F.struct(F.lit("Counterfactual").alias("series"), F.col("new_risk").alias("risk")),
    )
    return rescored(matrix, scorer, _free_scenario(ttft_pct, rl_pct)).select("company_id", F.inline(pair))
