"""Kaplan-Meier curves, bands, medians and the two-group log-rank test.

Durations are whole days, so after the first aggregate there is one row per
group and day; the windows below run over days, never over accounts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numeric import ratio

Z_95 = 1.959963984540054  # 0.975 quantile of the standard normal

HARD = ("days_to_hard_churn", "hard_churn_observed")
SOFT = ("days_to_soft_decay", "soft_decay_observed")


def event_table(rows: DataFrame, duration: str, event: str, group: str = "is_treatment") -> DataFrame:
    """Per group and day: events, censorings and accounts at risk.

    Day 0 is always present, as the start of the curve.
    """
    counts = rows.groupBy(F.col(group).alias("grp"), F.col(duration).cast("int").alias("t")).agg(
        F.count_if(F.col(event) == 1).alias("events"), F.count(F.lit(1)).alias("leaving")
    )
    start = counts.select("grp").distinct().select(
        "grp", F.lit(0).alias("t"), F.lit(0).cast("long").alias("events"), F.lit(0).cast("long").alias("leaving")
    )
    daily = counts.unionByName(start).groupBy("grp", "t").agg(
        F.sum("events").alias("events"), F.sum("leaving").alias("leaving")
    )
    from_here = Window.partitionBy("grp").orderBy("t").rowsBetween(0, Window.unboundedFollowing)
    return daily.select(
        "grp",
        "t",
        "events",
        (F.col("leaving") - F.col("events")).alias("censored"),
        F.sum("leaving").over(from_here).alias("at_risk"),
    )


def km_curve(rows: DataFrame, duration: str, event: str, group: str = "is_treatment") -> DataFrame:
    """Survival by group and day."""
    table = event_table(rows, duration, event, group)
    until = Window.partitionBy("grp").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    step = 1.0 - ratio("events", "at_risk")
    # ln(0) is NULL, so the day the last account leaves by an event is set apart.
    ended = F.max(F.when(F.col("events") == F.col("at_risk"), 1).otherwise(0)).over(until) == 1
    logs = F.sum(F.when(step > 0, F.log(step))).over(until)
    return table.select(
        "grp",
        "t",
        "at_risk",
        "events",
        "censored",
        F.when(ended, F.lit(0.0)).otherwise(F.exp(logs)).alias("survival"),
    )


def km_confidence(curve: DataFrame, z: float = Z_95) -> DataFrame:
    """Band from Greenwood's variance on the log(-log) scale; NULL where S is 0."""
    until = Window.partitionBy("grp").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    left = F.col("at_risk") - F.col("events")
    variance = F.sum(
        F.when(left > 0, ratio("events", F.col("at_risk").cast("double") * left)).otherwise(F.lit(0.0))
    ).over(until)
    survival = F.col("survival")
    log_s = F.log(survival)

    def bound(sign: float):
        shifted = F.log(-log_s) + F.lit(sign * z) * F.sqrt("greenwood") / -log_s
        return F.when(survival >= 1.0, F.lit(1.0)).when(survival > 0, F.exp(-F.exp(shifted)))

    banded = curve.withColumn("greenwood", variance)
    return banded.select(
        "grp", "t", "survival", bound(1.0).alias("lower_95"), bound(-1.0).alias("upper_95")
    )


def km_median(curve: DataFrame) -> DataFrame:
    """First day with survival at or below one half; NULL if never reached."""
    # A product of day factors may miss 0.5 by the last bits.
    reached = F.col("survival") <= F.lit(0.5 + 1e-12)
    return curve.groupBy("grp").agg(F.min(F.when(reached, F.col("t"))).alias("median_days"))


def chi2_tail_1df(statistic: Column) -> Column:
    """Upper tail of chi-square with one degree of freedom: erfc(sqrt(x / 2)).

    Small arguments use the all-positive series of erf, larger ones the
    continued fraction of erfc, evaluated from the inside out.
    """
    half = statistic / 2.0
    root = F.sqrt(half)
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def add_term(acc: Column, k: Column) -> Column:
        term = acc["term"] * half * 2.0 / (2.0 * k + 1.0)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    series = F.aggregate(F.sequence(F.lit(1), F.lit(60)), start, add_term, lambda acc: acc["total"])
    erf = root * F.exp(-half) * series * (2.0 / math.sqrt(math.pi))
    fraction = F.aggregate(
        F.sequence(F.lit(100), F.lit(1), F.lit(-1)), F.lit(1.0), lambda acc, k: 1.0 + k / (2.0 * half) / acc
    )
    erfc = F.exp(-half) / (root * math.sqrt(math.pi) * fraction)
    return F.when(half < 3.0, 1.0 - erf).otherwise(erfc)


def logrank_test(rows: DataFrame, duration: str, event: str, group: str = "is_treatment") -> DataFrame:
    """One row: observed and expected treated events, chi-square and p-value."""
    g = F.col(group)
    counts = rows.groupBy(F.col(duration).cast("int").alias("t")).agg(
        F.count_if(F.col(event) == 1).alias("d"),
        F.count_if((F.col(event) == 1) & g).alias("d1"),
        F.count(F.lit(1)).alias("leaving"),
        F.count_if(g).alias("leaving1"),
    )
    from_here = Window.orderBy("t").rowsBetween(0, Window.unboundedFollowing)
    n, n1, d = F.col("n").cast("double"), F.col("n1").cast("double"), F.col("d").cast("double")
    expected = ratio(d * n1, n)
    variance = F.when(n > 1, d * (n1 / n) * (1.0 - n1 / n) * (n - d) / (n - 1.0)).otherwise(F.lit(0.0))
    test = (
        counts.withColumns({"n": F.sum("leaving").over(from_here), "n1": F.sum("leaving1").over(from_here)})
        .where("d > 0")
        .agg(
            F.sum("d1").alias("observed"),
            F.sum(expected).alias("expected"),
            F.sum(variance).alias("variance"),
        )
    )
    gap = F.col("observed").cast("double") - F.col("expected")
    return test.withColumn("chi2", ratio(gap * gap, "variance")).withColumn(
        "p_value", chi2_tail_1df(F.col("chi2"))
    ).withColumn("is_significant", F.col("p_value") < 0.05)
