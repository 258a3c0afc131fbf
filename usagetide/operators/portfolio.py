"""Portfolio tables, the alert feed and per-account views.

Account views take ``account_id``; with None they cover every account, with an
id the filter reaches the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import business as B
from ..functions.numeric import equal_width_bin, exact_avg, ratio, round_to
from ..plans.models import company_days

# Columns of the feed.
ALERT_COLUMNS = [
    "company_name",
    "contract_tier",
    "industry",
    "churn_probability",
    "top_friction_trigger",
    "recommended_action",
    "action_owner",
    "count_429_onboarding",
    "avg_ttft_ms_onboarding",
]


def portfolio_kpis(scored: DataFrame, threshold: float = B.ALERT_THRESHOLD) -> DataFrame:
    high = F.col("churn_probability") >= F.lit(threshold)
    n, n_high = F.count(F.lit(1)), F.count_if(high)
    # An unknown tier has no value here, unlike in the scenarios.
    value = F.sum(F.when(high, B.arr_value("contract_tier", default=None)))
    return scored.agg(
        n.alias("n_accounts"),
        n_high.alias("n_high_risk"),
        round_to(ratio(n_high, n) * 100.0, 1).alias("high_risk_pct"),
        F.count_if(F.col("risk_tier") == "Critical").alias("n_critical"),
        F.coalesce(value, F.lit(0)).alias("arr_at_risk"),
    )


def alert_feed(
    scored: DataFrame,
    threshold: float = B.ALERT_THRESHOLD,
    tiers: Sequence[str] | None = ("Enterprise", "Growth"),
    industries: Sequence[str] | None = None,
) -> DataFrame:
    """Accounts at or above the threshold; None means no filter on that column."""
    rows = scored.where(F.col("churn_probability") >= F.lit(threshold))
    if tiers is not None:
        rows = rows.where(F.col("contract_tier").isin(*tiers))
    if industries is not None:
        rows = rows.where(F.col("industry").isin(*industries))
    return rows.select("company_id", *ALERT_COLUMNS)


def format_display(feed: DataFrame) -> DataFrame:
    """Alert feed with display strings."""
    return feed.select(
        "company_id",
        "company_name",
        "contract_tier",
        "industry",
        B.risk_badge("churn_probability").alias("risk_score"),
        "top_friction_trigger",
        "recommended_action",
        "action_owner",
        F.col("count_429_onboarding").cast("long").alias("count_429"),
        B.milliseconds_text("avg_ttft_ms_onboarding").alias("avg_ttft"),
        B.money_text(B.arr_value("contract_tier", default=None)).alias("arr"),
    )


def risk_histogram(scored: DataFrame, column: str = "churn_probability", bins: int = 30) -> DataFrame:
    """Counts in equal bins of [0, 1]; empty bins count 0."""
    filled = scored.groupBy(equal_width_bin(F.col(column), F.lit(0.0), F.lit(1.0), bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    spine = scored.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return spine.join(filled, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def risk_histogram_overlay(long_risk: DataFrame, bins: int = 30) -> DataFrame:
    """Counts per series and bin; both series share the bins, and empty bins count 0."""
    filled = long_risk.groupBy(
        "series", equal_width_bin(F.col("risk"), F.lit(0.0), F.lit(1.0), bins).alias("bin")
    ).agg(F.count(F.lit(1)).alias("n"))
    # A series has at most ``bins`` rows here, a handful of series in all.
    series = filled.select("series").distinct()
    spine = series.select("series", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return spine.join(filled, ["series", "bin"], "left").select("series", "bin", F.coalesce("n", F.lit(0)).alias("n"))


def risk_by_industry(scored: DataFrame) -> DataFrame:
    mean = exact_avg(F.col("churn_probability"), 4)
    return scored.groupBy("industry").agg(mean.alias("avg_churn_probability")).orderBy("avg_churn_probability")


def account_directory(scored: DataFrame) -> DataFrame:
    """Accounts by falling risk with a display label."""
    return scored.select(
        "company_id",
        "churn_probability",
        B.account_label("company_name", "churn_probability", "contract_tier").alias("label"),
    ).orderBy(F.desc("churn_probability"), "company_id")


def _only(rows: DataFrame, account_id) -> DataFrame:
    return rows if account_id is None else rows.where(F.col("company_id") == F.lit(account_id))


def account_usage(stg: DataFrame, account_id=None) -> DataFrame:
    return (
        _only(stg, account_id)
        .select("company_id", "usage_date", "day_since_signup", "total_tokens", "avg_ttft_ms")
        .orderBy("company_id", "usage_date")
    )


def account_rolling(stg: DataFrame, account_id=None, rows: int = 7) -> DataFrame:
    """Daily tokens with the unrounded mean of the last ``rows`` rows."""
    frame = company_days().rowsBetween(1 - rows, Window.currentRow)
    return _only(stg, account_id).select(
        "company_id", "usage_date", "total_tokens", F.avg("total_tokens").over(frame).alias("rolling_7d")
    )


def account_errors(errors: DataFrame, account_id=None) -> DataFrame:
    return _only(errors, account_id).select("error_id", "timestamp", "company_id", "error_code", "endpoint")


def account_errors_by_code(errors: DataFrame, account_id=None) -> DataFrame:
    return (
        _only(errors, account_id)
        .groupBy("company_id", F.col("error_code").cast("string").alias("error_code"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def account_429_daily(errors: DataFrame, account_id=None) -> DataFrame:
    return (
        _only(errors.where(F.col("error_code") == 429), account_id)
        .groupBy("company_id", F.col("timestamp").cast("date").alias("date"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def account_ttft_vs_portfolio(stg: DataFrame, account_id=None, factor: float = 1.5) -> DataFrame:
    """Onboarding latency per day against the portfolio mean, slow days flagged.

    The mean is a scalar subquery over the whole portfolio.
    """
    onboarding = stg.where(F.col("day_since_signup") <= 13)
    mean = onboarding.agg(exact_avg(F.col("avg_ttft_ms"), 2)).scalar()
    return (
        _only(onboarding, account_id)
        .select("company_id", "day_since_signup", "avg_ttft_ms")
        .withColumn("portfolio_avg_ttft", mean)
        .withColumn("is_slow", F.col("avg_ttft_ms") > F.col("portfolio_avg_ttft") * F.lit(factor))
    )


def account_card(scored: DataFrame, features: DataFrame, account_id=None) -> DataFrame:
    """Identity, risk level, prescription and five onboarding signals."""
    signals = _only(features, account_id).select(
        "company_id",
        F.col("count_429_onboarding").cast("long").alias("signal_429"),
        B.milliseconds_text("avg_ttft_ms_onboarding").alias("signal_ttft"),
        F.format_string("%.0f%%", F.rint(F.col("max_context_saturation_onboarding") * 100.0)).alias("signal_context"),
        F.format_string("%.0f%%", F.rint(F.col("avg_cache_ratio_onboarding") * 100.0)).alias("signal_cache"),
        F.when(
            F.col("token_growth_slope_onboarding").isNotNull(),
            F.format_string("%+.0f", F.rint("token_growth_slope_onboarding")),
        ).alias("signal_slope"),
    )
    card = _only(scored, account_id).select(
        "company_id",
        "company_name",
        "contract_tier",
        "industry",
        F.format_string("%.2f", F.col("churn_probability")).alias("churn_risk"),
        B.risk_level("churn_probability").alias("risk_level"),
        "friction_bucket",
        "top_friction_trigger",
        "recommended_action",
        "action_owner",
    )
    return card.join(signals, "company_id", "left")
