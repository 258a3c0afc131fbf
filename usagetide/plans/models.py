"""Staging, intermediate and fact models.

The large input is the usage series. It is shuffled once, on ``company_id``, by
the join in ``stg_daily_usage``; the windows of ``int_usage_velocity`` and the
aggregate of ``account_rollup`` run on that same partitioning. A company has
one row per day (``check_unique_company_day``), so a window partition is as
long as the history in days, however much traffic the company has.

The error log has no such bound: it is reduced to counts per company, day and
code before it meets any other table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import business as B
from ..functions.numeric import exact_avg, exact_slope, round_to

# The attributes of an account.
ACCOUNT_KEYS = [
    "company_id",
    "company_name",
    "industry",
    "contract_tier",
    "infra_risk_score",
    "growth_rate",
    "signup_date",
]
# Codes, horizon and thresholds of the labels.
ERROR_CODES = [429, 500, 503, 400]
HORIZON_DAYS = 90
HARD_CHURN_SHARE = 0.20
SOFT_DECAY_SHARE = 0.60


# ------------------------------------------------------------- staging


def stg_daily_usage(usage: DataFrame, companies: DataFrame) -> DataFrame:
    """Usage with company attributes; one row per company and day.

    No broadcast hint: the company table grows with the data, so the join
    strategy is left to its measured size.
    """
    joined = usage.join(companies, "company_id")
    day, signup = F.col("date").cast("date"), F.col("signup_date").cast("date")
    return joined.select(
        "log_id",
        day.alias("usage_date"),
        "company_id",
        "company_name",
        "industry",
        "contract_tier",
        signup.alias("signup_date"),
        "growth_rate",
        "infra_risk_score",
        F.col("input_tokens").cast("int").alias("input_tokens"),
        F.col("output_tokens").cast("int").alias("output_tokens"),
        F.col("prompt_cached_tokens").cast("int").alias("prompt_cached_tokens"),
        (F.col("input_tokens").cast("long") + F.col("output_tokens").cast("long")).alias("total_tokens"),
        B.cache_ratio("prompt_cached_tokens", "input_tokens").alias("prompt_cache_ratio"),
        round_to("avg_ttft_ms", 2).alias("avg_ttft_ms"),
        round_to("max_context_saturation_pct", 4).alias("max_context_saturation_pct"),
        B.onboarding_flag(day, signup).alias("is_onboarding_window"),
        B.day_since_signup(day, signup).alias("day_since_signup"),
    )


# ------------------------------------------------------------ velocity


def company_days():
    """Rows of one company in date order; ``log_id`` settles equal dates."""
    return Window.partitionBy("company_id").orderBy("usage_date", "log_id")


def rolling_mean(value: str, rows: int = 7) -> Column:
    """Mean of this row and the ``rows - 1`` before it (rows, not days)."""
    return F.avg(value).over(company_days().rowsBetween(1 - rows, 0))


def with_lags(stg: DataFrame) -> DataFrame:
    days = company_days()
    return stg.withColumns(
        {
            "raw_rolling": rolling_mean("total_tokens"),
            "prev_day_tokens": F.lag("total_tokens", 1).over(days),
            "tokens_7d_ago": F.lag("total_tokens", 7).over(days),
        }
    )


def int_usage_velocity(stg: DataFrame) -> DataFrame:
    return with_lags(stg).select(
        "log_id",
        "usage_date",
        "company_id",
        "company_name",
        "industry",
        "contract_tier",
        "signup_date",
        "day_since_signup",
        "is_onboarding_window",
        "infra_risk_score",
        "growth_rate",
        "input_tokens",
        "output_tokens",
        "prompt_cached_tokens",
        "total_tokens",
        "prompt_cache_ratio",
        "avg_ttft_ms",
        "max_context_saturation_pct",
        round_to("raw_rolling", 0).alias("rolling_7d_avg_tokens"),
        (F.col("total_tokens") - F.col("prev_day_tokens")).alias("dod_token_delta"),
        B.pct_change("total_tokens", "prev_day_tokens").alias("dod_pct_change"),
        B.pct_change("total_tokens", "tokens_7d_ago").alias("wow_pct_change"),
    )


# ------------------------------------------------------------ friction


def onboarding_aggregates(use: Column) -> list[Column]:
    """Usage statistics over the rows where ``use`` holds."""

    def pick(name: str) -> Column:
        return F.when(use, F.col(name))

    return [
        F.count_if(use).alias("onboarding_days_active"),
        F.avg(pick("total_tokens")).alias("avg_daily_tokens_onboarding"),
        F.max(pick("total_tokens")).alias("max_daily_tokens_onboarding"),
        exact_avg(pick("avg_ttft_ms"), 2).alias("avg_ttft_ms_onboarding"),
        F.max(pick("avg_ttft_ms")).alias("max_ttft_ms_onboarding"),
        exact_avg(pick("max_context_saturation_pct"), 4).alias("avg_context_saturation_onboarding"),
        F.max(pick("max_context_saturation_pct")).alias("max_context_saturation_onboarding"),
        exact_avg(pick("prompt_cache_ratio"), 4).alias("avg_cache_ratio_onboarding"),
        F.min(pick("usage_date")).alias("first_usage_date"),
        F.max(pick("usage_date")).alias("last_onboarding_date"),
    ]


def onboarding_usage(stg: DataFrame) -> DataFrame:
    flag = F.col("is_onboarding_window")
    return stg.where(flag).groupBy(*ACCOUNT_KEYS).agg(*onboarding_aggregates(flag))


def onboarding_errors(errors: DataFrame, companies: DataFrame) -> DataFrame:
    """Error count per company, day and code within the onboarding window."""
    daily = errors.groupBy(
        "company_id", F.col("timestamp").cast("date").alias("error_date"), "error_code"
    ).agg(F.count(F.lit(1)).alias("error_count"))
    signups = companies.select("company_id", "signup_date")
    return (
        daily.join(signups, "company_id")
        .where(B.onboarding_flag("error_date", "signup_date"))
        .select("company_id", "error_date", "error_code", "error_count")
    )


def error_pivot(counts: DataFrame) -> DataFrame:
    n = F.col("error_count")
    per_code = [
        F.sum(F.when(F.col("error_code") == code, n).otherwise(F.lit(0))).alias(f"count_{code}_onboarding")
        for code in ERROR_CODES
    ]
    return counts.groupBy("company_id").agg(*per_code, F.sum(n).alias("total_errors_onboarding"))


def _friction_columns() -> list[Column]:
    """Error counts with 0 for none, group flag and bucket."""
    counts = [f"count_{code}_onboarding" for code in ERROR_CODES] + ["total_errors_onboarding"]
    return [
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counts],
        B.treatment_flag("infra_risk_score").alias("is_treatment"),
        B.friction_bucket("infra_risk_score", "avg_ttft_ms_onboarding").alias("friction_bucket"),
    ]


def int_friction_flags(stg: DataFrame, errors: DataFrame, companies: DataFrame) -> DataFrame:
    return friction_flags(stg, onboarding_errors(errors, companies))


def friction_flags(stg: DataFrame, error_counts: DataFrame) -> DataFrame:
    usage = onboarding_usage(stg)
    pivoted = error_pivot(error_counts)
    return usage.join(pivoted, "company_id", "left").select(*[F.col(c) for c in usage.columns], *_friction_columns())


# -------------------------------------------------------------- cohort


def weekly_tokens(velocity: DataFrame) -> DataFrame:
    week = F.floor(F.col("day_since_signup") / F.lit(7.0).cast("double")).cast("int")
    return velocity.groupBy("company_id", week.alias("week_num")).agg(
        F.avg("rolling_7d_avg_tokens").alias("avg_weekly_tokens"),
        F.min("usage_date").alias("week_start_date"),
    )


def weekly_with_peak(velocity: DataFrame) -> DataFrame:
    company = Window.partitionBy("company_id")
    return weekly_tokens(velocity).withColumns(
        {
            "peak_weekly_tokens": F.max("avg_weekly_tokens").over(company),
            "prev_week_tokens": F.lag("avg_weekly_tokens", 1).over(company.orderBy("week_num")),
        }
    )


def int_cohort_health(velocity: DataFrame, sort: bool = True) -> DataFrame:
    weeks = weekly_with_peak(velocity).select(
        "company_id",
        "week_num",
        "week_start_date",
        round_to("avg_weekly_tokens", 0).alias("avg_weekly_tokens"),
        round_to("peak_weekly_tokens", 0).alias("peak_weekly_tokens"),
        B.rounded_ratio("avg_weekly_tokens", "peak_weekly_tokens").alias("retention_vs_peak"),
        B.rounded_ratio("avg_weekly_tokens", "prev_week_tokens").alias("wow_retention_rate"),
        F.coalesce(F.col("avg_weekly_tokens") == F.col("peak_weekly_tokens"), F.lit(False)).alias("is_peak_week"),
    )
    return weeks.orderBy("company_id", "week_num") if sort else weeks


# --------------------------------------------------------------- churn


def with_peak(velocity: DataFrame) -> DataFrame:
    """Add the peak of the rounded rolling mean and its first date, without a self join."""
    company = Window.partitionBy("company_id")
    level = F.col("rolling_7d_avg_tokens")
    peaked = velocity.withColumn("peak_rolling_avg", F.max(level).over(company))
    at_peak = F.when(level == F.col("peak_rolling_avg"), F.col("usage_date"))
    return peaked.withColumn("peak_date", F.min(at_peak).over(company))


def peak_per_company(velocity: DataFrame) -> DataFrame:
    return velocity.groupBy("company_id").agg(F.max("rolling_7d_avg_tokens").alias("peak_rolling_avg"))


def first_peak_date(velocity: DataFrame) -> DataFrame:
    """One aggregate: the least (negated level, date) pair is the first peak."""
    best = F.min(F.struct((-F.col("rolling_7d_avg_tokens")).alias("negated"), F.col("usage_date")))
    return velocity.groupBy("company_id").agg(best.alias("best")).select(
        "company_id",
        (-F.col("best.negated")).alias("peak_rolling_avg"),
        F.col("best.usage_date").alias("peak_date"),
    )


def onset_aggregates(hard_share: float = HARD_CHURN_SHARE, soft_share: float = SOFT_DECAY_SHARE) -> list[Column]:
    """First dates after the peak at or below a share of it; needs ``with_peak``."""
    peak = F.col("peak_rolling_avg")
    after = (F.col("usage_date") > F.col("peak_date")) & (peak > 0)

    def first_below(share: float) -> Column:
        low = F.col("rolling_7d_avg_tokens") <= peak * F.lit(share)
        return F.min(F.when(after & low, F.col("usage_date")))

    return [
        first_below(hard_share).alias("hard_churn_date"),
        first_below(soft_share).alias("soft_decay_date"),
    ]


def post_peak_scan(velocity: DataFrame) -> DataFrame:
    """Rows dated strictly after their company's first peak."""
    return with_peak(velocity).where(F.col("usage_date") > F.col("peak_date"))


def churn_onset(
    velocity: DataFrame, hard_share: float = HARD_CHURN_SHARE, soft_share: float = SOFT_DECAY_SHARE
) -> DataFrame:
    return (
        post_peak_scan(velocity)
        .groupBy("company_id")
        .agg(F.first("peak_rolling_avg").alias("peak_rolling_avg"), *onset_aggregates(hard_share, soft_share))
    )


def trend_aggregates() -> list[Column]:
    """Conditional statistics over ranges of days since signup."""
    day = F.col("day_since_signup")

    def on(first: int, last: int, name: str) -> Column:
        return F.when(day.between(first, last), F.col(name))

    return [
        F.avg(on(0, 13, "total_tokens")).alias("raw_tokens_0_14"),
        F.avg(on(14, 29, "total_tokens")).alias("raw_tokens_15_30"),
        F.avg(on(30, 59, "total_tokens")).alias("raw_tokens_31_60"),
        exact_avg(on(0, 13, "avg_ttft_ms"), 2).alias("raw_ttft_0_14"),
        F.max(on(0, 13, "avg_ttft_ms")).alias("raw_max_ttft_0_14"),
        exact_avg(on(0, 13, "prompt_cache_ratio"), 4).alias("raw_cache_0_14"),
        exact_avg(on(14, 29, "prompt_cache_ratio"), 4).alias("raw_cache_15_30"),
        exact_avg(on(0, 13, "max_context_saturation_pct"), 4).alias("raw_ctx_0_14"),
        F.max(on(0, 13, "max_context_saturation_pct")).alias("raw_max_ctx_0_14"),
        exact_avg(on(7, 13, "wow_pct_change"), 2).alias("raw_wow_week2"),
    ]


# Names of the trend columns.
TREND_OUTPUT = [
    ("raw_tokens_0_14", "avg_tokens_days_0_14", 0),
    ("raw_tokens_15_30", "avg_tokens_days_15_30", 0),
    ("raw_tokens_31_60", "avg_tokens_days_31_60", 0),
    ("raw_ttft_0_14", "avg_ttft_days_0_14", 2),
    ("raw_max_ttft_0_14", "max_ttft_days_0_14", 2),
    ("raw_cache_0_14", "avg_cache_ratio_0_14", 4),
    ("raw_cache_15_30", "avg_cache_ratio_15_30", 4),
    ("raw_ctx_0_14", "avg_ctx_sat_0_14", 4),
    ("raw_max_ctx_0_14", "max_ctx_sat_0_14", 4),
    ("raw_wow_week2", "avg_wow_pct_change_week2", 2),
]


def _trend_columns() -> list[Column]:
    return [round_to(raw, digits).alias(name) for raw, name, digits in TREND_OUTPUT]


def velocity_trends(velocity: DataFrame) -> DataFrame:
    return velocity.groupBy("company_id").agg(*trend_aggregates()).select("company_id", *_trend_columns())


def slope_aggregate() -> Column:
    day = F.col("day_since_signup")
    return exact_slope(F.col("total_tokens"), day, day.between(0, 13)).alias("raw_slope")


def growth_slope(velocity: DataFrame) -> DataFrame:
    """Linear token trend on days 0-13, for companies with rows in that range."""
    return (
        velocity.where(F.col("day_since_signup").between(0, 13))
        .groupBy("company_id")
        .agg(slope_aggregate())
        .withColumnRenamed("raw_slope", "token_growth_slope_onboarding")
    )


def momentum_ratio() -> Column:
    return B.rounded_ratio("raw_tokens_15_30", "raw_tokens_0_14")


# --------------------------------------------------------------- facts


def account_rollup(
    velocity: DataFrame, hard_share: float = HARD_CHURN_SHARE, soft_share: float = SOFT_DECAY_SHARE
) -> DataFrame:
    """All per-company statistics of the usage series in one aggregate.

    Both fact models read from here, so the series is scanned and shuffled once
    for them; Catalyst drops the aggregates that a query does not use.
    Companies without an onboarding row are left out, as in the friction model.
    """
    return (
        with_peak(velocity)
        .groupBy(*ACCOUNT_KEYS)
        .agg(
            *onboarding_aggregates(F.col("is_onboarding_window")),
            F.max("peak_rolling_avg").alias("peak_rolling_avg"),
            F.max("peak_date").alias("peak_date"),
            *onset_aggregates(hard_share, soft_share),
            *trend_aggregates(),
            slope_aggregate(),
        )
        .where(F.col("onboarding_days_active") > 0)
    )


def churn_label_columns(horizon: int = HORIZON_DAYS) -> list[Column]:
    """Labels, durations censored at ``horizon`` and 0/1 event flags."""

    def duration(event: str) -> Column:
        return F.coalesce(F.datediff(F.col(event), F.col("signup_date")), F.lit(horizon))

    hard, soft = F.col("hard_churn_date").isNotNull(), F.col("soft_decay_date").isNotNull()
    return [
        hard.alias("hard_churn_label"),
        soft.alias("soft_decay_label"),
        duration("hard_churn_date").alias("days_to_hard_churn"),
        duration("soft_decay_date").alias("days_to_soft_decay"),
        hard.cast("int").alias("hard_churn_observed"),
        soft.cast("int").alias("soft_decay_observed"),
    ]


def _accounts(rollup: DataFrame, error_counts: DataFrame, horizon: int) -> DataFrame:
    """Rollup with friction and label columns; error counts are one row per company."""
    return (
        rollup.join(error_pivot(error_counts), "company_id", "left")
        .select(*[F.col(c) for c in rollup.columns], *_friction_columns(), *churn_label_columns(horizon))
        .withColumn("peak_rolling_avg_tokens", round_to("peak_rolling_avg", 0))
    )


# Output columns in order.
COHORT_CHURN_COLUMNS = [
    "company_id",
    "company_name",
    "industry",
    "contract_tier",
    "signup_date",
    "infra_risk_score",
    "growth_rate",
    "friction_bucket",
    "avg_daily_tokens_onboarding",
    "avg_ttft_ms_onboarding",
    "max_ttft_ms_onboarding",
    "avg_context_saturation_onboarding",
    "max_context_saturation_onboarding",
    "avg_cache_ratio_onboarding",
    "count_429_onboarding",
    "count_500_onboarding",
    "count_503_onboarding",
    "total_errors_onboarding",
    "is_treatment",
    "is_control",
    "peak_rolling_avg_tokens",
    "peak_date",
    "hard_churn_label",
    "soft_decay_label",
    "days_to_hard_churn",
    "days_to_soft_decay",
    "hard_churn_observed",
    "soft_decay_observed",
]


def fct_cohort_churn(rollup: DataFrame, error_counts: DataFrame, horizon: int = HORIZON_DAYS) -> DataFrame:
    accounts = _accounts(rollup, error_counts, horizon)
    return accounts.withColumn("is_control", ~F.col("is_treatment")).select(*COHORT_CHURN_COLUMNS)


def fct_account_features(rollup: DataFrame, error_counts: DataFrame, horizon: int = HORIZON_DAYS) -> DataFrame:
    accounts = _accounts(rollup, error_counts, horizon)
    return accounts.select(
        "company_id",
        "company_name",
        "industry",
        "contract_tier",
        "signup_date",
        "infra_risk_score",
        "growth_rate",
        "friction_bucket",
        "is_treatment",
        "hard_churn_label",
        "soft_decay_label",
        "days_to_hard_churn",
        "days_to_soft_decay",
        "hard_churn_observed",
        "soft_decay_observed",
        "peak_rolling_avg_tokens",
        "count_429_onboarding",
        "count_500_onboarding",
        "count_503_onboarding",
        "total_errors_onboarding",
        "avg_ttft_ms_onboarding",
        "max_ttft_ms_onboarding",
        "avg_context_saturation_onboarding",
        "max_context_saturation_onboarding",
        "avg_cache_ratio_onboarding",
        *_trend_columns(),
        round_to("raw_slope", 2).alias("token_growth_slope_onboarding"),
        momentum_ratio().alias("token_momentum_w2_vs_w1"),
    )
