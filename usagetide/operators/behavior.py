"""Behaviour tables: onset, curves, heatmaps, segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import business as B
from ..functions.numeric import bin_start, bin_width, equal_width_bin, exact_avg, ratio, round_to
from ..functions.skew import HOT_ROWS, join_split_hot


def _share(part: Column, whole: Column, digits: int = 1) -> Column:
    return round_to(ratio(part, whole) * 100.0, digits)


def _spine(df: DataFrame, first: int, last: int, name: str) -> DataFrame:
    """The whole numbers ``first..last``, one per row."""
    return df.sparkSession.range(first, last + 1).select(F.col("id").cast("int").alias(name))


# -------------------------------------------------------- group summaries


def churn_by_group(churn: DataFrame) -> DataFrame:
    churned = F.count_if(F.col("hard_churn_label"))
    return (
        churn.groupBy(F.when(F.col("is_treatment"), F.lit("Treatment")).otherwise(F.lit("Control")).alias("grp"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            churned.alias("churned"),
            _share(churned, F.count(F.lit(1))).alias("churn_pct"),
        )
        .orderBy(F.desc("grp"))
    )


def cohort_overview(churn: DataFrame) -> DataFrame:
    treated, churned = F.col("is_treatment"), F.col("hard_churn_label")
    n, n_t = F.count(F.lit(1)), F.count_if(treated)
    return churn.agg(
        n.alias("n_total"),
        n_t.alias("n_treatment"),
        (n - n_t).alias("n_control"),
        _share(n_t, n).alias("treatment_pct"),
        _share(n - n_t, n).alias("control_pct"),
        F.avg(F.when(treated, F.col("days_to_hard_churn"))).alias("avg_onset_treatment"),
        _share(F.count_if(treated & churned), n_t).alias("churn_pct_treatment"),
        _share(F.count_if(~treated & churned), n - n_t).alias("churn_pct_control"),
    )


def churn_by_day(churn: DataFrame, days: Sequence[int] = (30, 60, 90), events_only: bool = False) -> DataFrame:
    """Accounts whose duration is at most each day of ``days``; one pass."""
    counted = F.col("hard_churn_observed") == 1 if events_only else F.lit(True)
    by_day = [
        F.struct(
            F.lit(int(d)).alias("day"),
            F.count_if((F.col("days_to_hard_churn") <= d) & counted).alias("n_churned"),
        )
        for d in days
    ]
    return (
        churn.agg(F.count(F.lit(1)).alias("n_total"), F.array(*by_day).alias("rows"))
        .select("n_total", F.inline("rows"))
        .select("day", "n_churned", _share(F.col("n_churned"), F.col("n_total")).alias("pct"))
    )


def cumulative_churn(churn: DataFrame, last_day: int = 90, events_only: bool = False) -> DataFrame:
    """Percent of accounts with a duration of at most d, for d = 0..last_day."""
    counted = F.col("hard_churn_observed") == 1 if events_only else F.lit(True)
    per_day = churn.groupBy(F.greatest(F.col("days_to_hard_churn"), F.lit(0)).alias("day")).agg(
        F.count_if(counted).alias("n"), F.count(F.lit(1)).alias("n_all")
    )
    # One row per distinct duration: the window below sees days, not accounts.
    counts = per_day.where(F.col("day") <= last_day).select("day", "n")
    n_total = per_day.agg(F.sum("n_all")).scalar()
    running = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return (
        _spine(churn, 0, last_day, "day")
        .join(counts, "day", "left")
        .select("day", F.sum(F.coalesce("n", F.lit(0))).over(running).alias("n_churned"))
        .withColumn("n_total", n_total)
        .select("day", "n_churned", (ratio("n_churned", "n_total") * 100.0).alias("cumulative_pct"))
    )


def onset_histogram(churn: DataFrame, bins: int = 20) -> DataFrame:
    """Equal-width histogram of the onset day of churned accounts, with the median; empty bins count 0.

    No rows where no account churned.
    """
    # Durations are whole days, so this is at most one row per day.
    days = (
        churn.where("hard_churn_label").groupBy(F.col("days_to_hard_churn").alias("day")).agg(
            F.count(F.lit(1)).alias("n")
        )
    )
    edges = days.agg(
        F.struct(
            F.min("day").alias("low"), F.max("day").alias("high"), F.percentile("day", F.lit(0.5), F.col("n")).alias("median")
        )
    ).scalar()
    low, high = F.col("edges.low"), F.col("edges.high")
    filled = (
        days.withColumn("edges", edges)
        .withColumn("bin", equal_width_bin(F.col("day"), low, high, bins))
        .groupBy("bin")
        .agg(F.sum("n").alias("n"))
    )
    return (
        _spine(churn, 0, bins - 1, "bin")
        .join(filled, "bin", "left")
        .withColumn("edges", edges)
        .where("edges.low IS NOT NULL")
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .select(
            "bin",
            bin_start(low, high, bins, F.col("bin")).alias("bin_start"),
            (bin_start(low, high, bins, F.col("bin")) + bin_width(low, high, bins)).alias("bin_end"),
            "n",
            F.col("edges.median").alias("median_onset"),
        )
    )


def median_onset(churn: DataFrame) -> DataFrame:
    """Median duration of treated accounts (durations are whole days)."""
    return churn.where("is_treatment").agg(F.percentile("days_to_hard_churn", 0.5).alias("median_onset_days"))


# ------------------------------------------------------------------ curves


def usage_join_onset(stg: DataFrame, churn: DataFrame) -> DataFrame:
    """Usage rows of churned accounts with the day relative to churn onset."""
    timing = churn.where("hard_churn_label").select("company_id", "days_to_hard_churn")
    onset = F.date_add(F.col("signup_date"), F.col("days_to_hard_churn"))
    return stg.join(timing, "company_id").select(
        "company_id",
        "usage_date",
        "total_tokens",
        onset.alias("churn_onset_date"),
        F.datediff(F.col("usage_date"), onset).alias("days_to_onset"),
    )


def pre_churn_curve(stg: DataFrame, churn: DataFrame, before: int = 21, after: int = 7) -> DataFrame:
    return (
        usage_join_onset(stg, churn)
        .where(F.col("days_to_onset").between(-before, after))
        .groupBy("days_to_onset")
        .agg(F.avg("total_tokens").alias("avg_tokens"), F.count(F.lit(1)).alias("n_rows"))
    )


def group_semi_join(rows: DataFrame, churn: DataFrame, treated: bool) -> DataFrame:
    """Rows whose company belongs to the treated (or control) group."""
    wanted = F.col("is_treatment") if treated else ~F.col("is_treatment")
    return rows.join(churn.where(wanted).select("company_id"), "company_id", "left_semi")


def control_baseline(stg: DataFrame, churn: DataFrame) -> DataFrame:
    return group_semi_join(stg, churn, treated=False).agg(F.avg("total_tokens").alias("control_avg_tokens"))


# ----------------------------------------------------------------- heatmap


def usage_join_bucket(stg: DataFrame, churn: DataFrame) -> DataFrame:
    return stg.join(churn.select("company_id", "friction_bucket"), "company_id").select(
        "company_id",
        "usage_date",
        "friction_bucket",
        "total_tokens",
        "day_since_signup",
        B.day_bin("day_since_signup").alias("day_bin"),
    )


def _bin_column(label: str) -> str:
    return label.lower().replace(" ", "_").replace("-", "_")


HEATMAP_COLUMNS = [_bin_column(label) for label in B.DAY_BIN_LABELS]


def cohort_heatmap(stg: DataFrame, churn: DataFrame) -> DataFrame:
    """Mean tokens by friction bucket and day range; all rows and columns present."""
    binned = usage_join_bucket(stg, churn).where(F.col("day_bin").isNotNull())
    means = binned.groupBy("friction_bucket").agg(
        *[
            F.avg(F.when(F.col("day_bin") == label, F.col("total_tokens"))).alias(name)
            for label, name in zip(B.DAY_BIN_LABELS, HEATMAP_COLUMNS)
        ]
    )
    order = churn.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(b) for b in B.FRICTION_BUCKETS])).alias("row_no", "friction_bucket")
    )
    return order.join(means, "friction_bucket", "left").orderBy("row_no").select(
        "row_no", "friction_bucket", *HEATMAP_COLUMNS
    )


def heatmap_relative(heatmap: DataFrame) -> DataFrame:
    base = HEATMAP_COLUMNS[0]
    return heatmap.select(
        "row_no", "friction_bucket", *[ratio(c, base).alias(c) for c in HEATMAP_COLUMNS]
    )


def heatmap_finding(heatmap: DataFrame) -> DataFrame:
    """Late change against the first range: drop of Severe, growth of None."""
    early, late = HEATMAP_COLUMNS[0], HEATMAP_COLUMNS[4]

    def change(bucket: str) -> Column:
        return F.max(F.when(F.col("friction_bucket") == bucket, ratio(late, early)))

    return heatmap.agg(
        ((1.0 - change("Severe")) * 100.0).alias("severe_drop_pct"),
        ((change("None") - 1.0) * 100.0).alias("none_growth_pct"),
    )


# -------------------------------------------------------------- onboarding


def distinct_signups(stg: DataFrame) -> DataFrame:
    return stg.select("company_id", "signup_date").dropDuplicates()


def errors_join_signup(errors: DataFrame, companies: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Single error events within the onboarding window of their company.

    The event rows of a company with very many events are split over tasks.
    """
    day = F.col("timestamp").cast("date")
    signups = companies.select("company_id", "signup_date")
    return (
        join_split_hot(errors, signups, "company_id", "error_id", hot_rows)
        .where(B.onboarding_flag(day, "signup_date"))
        .select("error_id", "company_id", day.alias("error_date"), "error_code", "signup_date")
    )


def errors_join_signup_day(errors: DataFrame, stg: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Single error events with their day since signup; hot companies are split."""
    return join_split_hot(errors, distinct_signups(stg), "company_id", "error_id", hot_rows).select(
        "error_id",
        "company_id",
        "error_code",
        B.day_since_signup(F.col("timestamp").cast("date"), "signup_date").alias("day_since_signup"),
    )


def errors_by_onboarding_day(errors: DataFrame, churn: DataFrame, code: int = 429) -> DataFrame:
    """Count of one code per onboarding day for treated accounts, zero-filled.

    Events are counted per company and day before the join; ``churn`` holds the signup dates.
    """
    daily = (
        errors.where(F.col("error_code") == code)
        .groupBy("company_id", F.col("timestamp").cast("date").alias("error_date"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    placed = (
        daily.join(churn.where("is_treatment").select("company_id", "signup_date"), "company_id")
        .select(B.day_since_signup("error_date", "signup_date").alias("day_since_signup"), "n")
        .where(F.col("day_since_signup").between(0, 13))
        .groupBy("day_since_signup")
        .agg(F.sum("n").alias("n"))
    )
    return (
        _spine(errors, 0, 13, "day_since_signup")
        .join(placed, "day_since_signup", "left")
        .select("day_since_signup", F.coalesce("n", F.lit(0)).alias("error_events"))
    )


def ttft_by_day_group(stg: DataFrame, churn: DataFrame) -> DataFrame:
    return (
        stg.where(F.col("day_since_signup").between(0, 13))
        .join(churn.select("company_id", "is_treatment"), "company_id")
        .groupBy("day_since_signup", "is_treatment")
        .agg(exact_avg(F.col("avg_ttft_ms"), 2).alias("avg_ttft_ms"))
    )


# ---------------------------------------------------------------- segments


def churn_by_industry(churn: DataFrame) -> DataFrame:
    """Churn percent by industry, one column per group."""
    label = F.col("hard_churn_label").cast("int")

    def rate(group: Column) -> Column:
        return F.avg(F.when(group, label)) * 100.0

    return churn.groupBy("industry").agg(
        rate(F.col("is_treatment")).alias("treatment"), rate(~F.col("is_treatment")).alias("control")
    )


def time_to_churn_by_tier(churn: DataFrame) -> DataFrame:
    days = F.col("days_to_hard_churn")
    return (
        churn.where("is_treatment")
        .groupBy("contract_tier")
        .agg(
            F.avg(days).alias("mean_days"),
            F.stddev_samp(days).alias("std_days"),
            F.count(days).alias("n"),
        )
    )


def group_counts(rows: DataFrame, column: str) -> DataFrame:
    """Rows per value, largest first."""
    return rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), "value"
    )
