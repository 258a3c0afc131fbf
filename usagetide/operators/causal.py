"""Propensity covariates, scores and covariate balance."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import equal_width_bin, bin_start, bin_width, ratio, round_to
from ..functions.selection import exact_quantiles
from ..session import materialize

BASE_COVARIATES = ["is_enterprise", "log_avg_tokens_onboarding", "growth_rate"]
BALANCE_LIMIT = 0.10
CALIPER_SHARE = 0.05


def industry_levels(features: DataFrame) -> list[str]:
    """The industry vocabulary: a short list, one entry per category."""
    rows = features.select("industry").where(F.col("industry").isNotNull()).distinct().collect()
    return sorted(row[0] for row in rows)


def covariate_names(levels: Sequence[str]) -> list[str]:
    return [*BASE_COVARIATES, *[f"ind_{level}" for level in levels]]


def psm_covariates(features: DataFrame, levels: Sequence[str] | None = None) -> DataFrame:
    """Features with one 0/1 column per industry, tier flag and log token level."""
    levels = industry_levels(features) if levels is None else levels
    added: dict[str, Column] = {
        "is_enterprise": (F.col("contract_tier") == "Enterprise").cast("double"),
        "log_avg_tokens_onboarding": F.log1p(F.coalesce(F.col("avg_tokens_days_0_14"), F.lit(0.0))),
        "growth_rate": F.coalesce(F.col("growth_rate"), F.lit(0.0)),
    }
    for level in levels:
        added[f"ind_{level}"] = (F.col("industry") == level).cast("double")
    return features.withColumns(added).fillna(0.0, subset=covariate_names(levels))


def standardize(df: DataFrame, columns: Sequence[str], suffix: str = "_z") -> DataFrame:
    """Add zero-mean, unit population deviation versions of ``columns``.

    The moments come from one aggregate read as a scalar subquery. A constant
    column becomes 0.
    """
    moments = df.agg(
        F.struct(
            *[F.avg(c).alias(f"mean_{i}") for i, c in enumerate(columns)],
            *[F.stddev_pop(c).alias(f"dev_{i}") for i, c in enumerate(columns)],
        )
    ).scalar()
    scaled = df.withColumn("_moments", moments)
    for i, c in enumerate(columns):
        centred = F.col(c) - F.col(f"_moments.mean_{i}")
        dev = F.col(f"_moments.dev_{i}")
        scaled = scaled.withColumn(f"{c}{suffix}", F.when(dev > 1e-12, centred / dev).otherwise(F.lit(0.0)))
    return scaled.drop("_moments")


def fit_propensity(
    df: DataFrame, columns: Sequence[str], rows: int, penalty_c: float = 1.0, iterations: int = 1000
) -> LogisticRegressionModel:
    """L2 logistic regression of treatment; the penalty is per data set, not per row."""
    data = VectorAssembler(inputCols=list(columns), outputCol="covariates").transform(df)
    data = data.withColumn("treated", F.col("is_treatment").cast("double"))
    return LogisticRegression(
        featuresCol="covariates",
        labelCol="treated",
        regParam=1.0 / (penalty_c * max(rows, 1)),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=iterations,
        tol=1e-8,
    ).fit(data)


def _newton_sums(df: DataFrame, columns: Sequence[str], beta: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Gradient and Hessian of the unpenalised loss at ``beta`` (intercept first), and the loss: one aggregate."""
    x = [F.lit(1.0), *[F.col(f"`{c}`") for c in columns]]
    margin = F.lit(float(beta[0]))
    for b, c in zip(beta[1:], x[1:]):
        margin = margin + F.lit(float(b)) * c
    y = F.col("is_treatment").cast("double")
    rows = df.select(*x[1:], margin.alias("margin"), y.alias("y")).withColumn("p", 1.0 / (1.0 + F.exp(-F.col("margin"))))
    rows = rows.withColumn("w", F.col("p") * (1.0 - F.col("p"))).withColumn("r", F.col("p") - F.col("y"))
    # log(1 + exp(m)) - y * m without overflow.
    loss = F.greatest(F.col("margin"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("margin"))) - F.col("y") * F.col("margin")
    n = len(x)
    sums = [F.sum(F.col("r") * x[i]) for i in range(n)]
    sums += [F.sum(F.col("w") * x[i] * x[j]) for i in range(n) for j in range(i, n)]
    found = [0.0 if v is None else float(v) for v in rows.agg(*sums, F.sum(loss)).first()]
    hessian = np.zeros((n, n))
    hessian[np.triu_indices(n)] = found[n:-1]
    return np.array(found[:n]), hessian + np.triu(hessian, 1).T, found[-1]


def newton_propensity(
    df: DataFrame, columns: Sequence[str], penalty_c: float = 1.0, steps: int = 50, tolerance: float = 1e-10
) -> np.ndarray:
    """Coefficients, intercept first, of the L2 logistic regression of treatment.

    Newton's method: every step is one aggregate over the accounts that sums the weighted normal equations, whose
    size is the number of covariates squared, and one small system on the driver. A step that does not lower the
    penalised loss is halved. The intercept has no penalty; one class alone has none to separate and gives zeros.
    """
    n = len(columns) + 1
    penalty = np.diag([0.0] + [1.0 / penalty_c] * len(columns))
    beta, step = np.zeros(n), np.zeros(n)
    treated, rows = df.agg(F.count_if("is_treatment"), F.count(F.lit(1))).first()
    if treated in (0, rows):
        return beta
    best = np.inf
    for _ in range(steps):
        gradient, hessian, loss = _newton_sums(df, columns, beta + step)
        tried = beta + step
        loss += 0.5 * tried @ penalty @ tried
        if loss > best * (1 + 1e-12):
            step = step / 2
            continue
        beta, best = tried, loss
        gradient = gradient + penalty @ beta
        if np.abs(gradient).max() <= tolerance * rows:
            break
        step = -np.linalg.lstsq(hessian + penalty, gradient, rcond=None)[0]
    return beta


def propensity_gradient(df: DataFrame, columns: Sequence[str], beta: np.ndarray, penalty_c: float = 1.0) -> DataFrame:
    """Penalised gradient per coefficient and account: all zeros exactly at the optimum of a convex loss."""
    gradient, _, _ = _newton_sums(df, columns, beta)
    total = gradient + np.concatenate(([0.0], beta[1:] / penalty_c))
    rows = [(name, float(g) / max(df.count(), 1)) for name, g in zip(["intercept", *columns], total)]
    return df.sparkSession.createDataFrame(rows, "covariate string, gradient double")


def propensity_inputs(features: DataFrame) -> tuple[DataFrame, list[str], list[str]]:
    """Stored features with covariates and their standardised versions; names of both.

    The features are stored first: levels, moments, fit and scores all read them.
    """
    features = materialize(features)
    levels = industry_levels(features)
    names = covariate_names(levels)
    scaled = standardize(psm_covariates(features, levels), names)
    return materialize(scaled), names, [f"{c}_z" for c in names]


def propensity_score(features: DataFrame, penalty_c: float = 1.0) -> DataFrame:
    """Features with covariates and ``propensity_score``, the fitted probability of treatment."""
    scaled, _, inputs = propensity_inputs(features)
    beta = newton_propensity(scaled, inputs, penalty_c)
    margin = F.lit(float(beta[0]))
    for b, c in zip(beta[1:], inputs):
        margin = margin + F.lit(float(b)) * F.col(f"`{c}`")
    return scaled.withColumn("propensity_score", 1.0 / (1.0 + F.exp(-margin))).drop(*inputs)


# ------------------------------------------------------- score summaries


def propensity_summary(scored: DataFrame, score: str = "propensity_score") -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles of the score by group."""
    scored = materialize(scored.select("is_treatment", score))
    by_group = scored.groupBy("is_treatment").agg(
        F.count(score).alias("n"),
        F.avg(score).alias("mean"),
        F.stddev_samp(score).alias("std"),
        F.min(score).alias("min"),
        F.max(score).alias("max"),
    )
    quartiles = exact_quantiles(scored, score, [0.25, 0.5, 0.75], ["is_treatment"], stored=True)
    return by_group.join(F.broadcast(quartiles), "is_treatment").select(
        "is_treatment", "n", "mean", "std", "min", "q_25", "q_50", "q_75", "max"
    )


def propensity_overlap(scored: DataFrame, score: str = "propensity_score", bins: int = 25) -> DataFrame:
    """Density histogram of the score per group over that group's own range."""
    ranges = scored.groupBy("is_treatment").agg(
        F.min(score).alias("low"), F.max(score).alias("high"), F.count(score).alias("n_group")
    )
    low, high = F.col("low"), F.col("high")
    return (
        scored.join(F.broadcast(ranges), "is_treatment")  # one row per group
        .groupBy("is_treatment", "low", "high", "n_group", equal_width_bin(F.col(score), low, high, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "is_treatment",
            F.col("low").alias("range_min"),
            F.col("high").alias("range_max"),
            "bin",
            bin_start(low, high, bins, F.col("bin")).alias("bin_start"),
            "n",
            ratio("n", F.col("n_group") * bin_width(low, high, bins)).alias("density"),
        )
    )


# --------------------------------------------------------------- balance


def _smd_parts(columns: Sequence[str], group: Column, prefix: str) -> list[Column]:
    """Mean and sample variance per covariate for treated and control rows."""
    parts = []
    for i, c in enumerate(columns):
        for side, cond in (("t", group & F.col("is_treatment")), ("c", group & ~F.col("is_treatment"))):
            value = F.when(cond, F.col(c).cast("double"))
            parts.append(F.avg(value).alias(f"{prefix}_mean_{side}_{i}"))
            parts.append(F.var_samp(value).alias(f"{prefix}_var_{side}_{i}"))
    return parts


def _smd_value(prefix: str, i: int) -> Column:
    def part(kind: str, side: str) -> Column:
        return F.col(f"{prefix}_{kind}_{side}_{i}")

    pooled = F.sqrt((part("var", "t") + part("var", "c")) / 2.0)
    gap = F.abs(part("mean", "t") - part("mean", "c"))
    return F.when(pooled > 0, gap / pooled).otherwise(F.lit(0.0))


def smd(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Standardized mean difference per covariate; one pass for all covariates."""
    moments = df.agg(*_smd_parts(columns, F.lit(True), "a"))
    rows = [F.struct(F.lit(c).alias("covariate"), _smd_value("a", i).alias("smd")) for i, c in enumerate(columns)]
    return moments.select(F.inline(F.array(*rows)))


def balance_table(df: DataFrame, pairs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """SMD before and after matching, 3 digits, with the balance verdicts.

    Matched rows are flagged once, and both sets of moments come from one
    aggregate over the accounts.
    """
    flagged = df.join(matched_ids(pairs), "company_id", "left").withColumn(
        "is_matched", F.coalesce(F.col("is_matched"), F.lit(False))
    )
    moments = flagged.agg(
        *_smd_parts(columns, F.lit(True), "b"), *_smd_parts(columns, F.col("is_matched"), "a")
    )
    after = [_smd_value("a", i) for i in range(len(columns))]
    rows = [
        F.struct(
            F.lit(c).alias("covariate"),
            round_to(_smd_value("b", i), 3).alias("smd_before"),
            round_to(after[i], 3).alias("smd_after"),
            (after[i] < F.lit(BALANCE_LIMIT)).alias("is_balanced"),
        )
        for i, c in enumerate(columns)
    ]
    rounded = [round_to(a, 3) for a in after]
    worst = F.array_max(F.array(*rounded))
    return moments.select(worst.alias("max_smd_after"), F.inline(F.array(*rows))).select(
        "covariate",
        "smd_before",
        "smd_after",
        "is_balanced",
        "max_smd_after",
        (F.col("max_smd_after") < F.lit(BALANCE_LIMIT)).alias("all_balanced"),
    )


def matched_ids(pairs: DataFrame) -> DataFrame:
    """Ids of both sides of the pairs; an id occurs in one pair at most."""
    treated = pairs.select(F.col("treatment_company_id").alias("company_id"))
    control = pairs.select(F.col("control_company_id").alias("company_id"))
    return treated.unionByName(control).withColumn("is_matched", F.lit(True))


def matched_cohort(churn: DataFrame, pairs: DataFrame) -> DataFrame:
    """Outcome columns of matched treated accounts followed by matched controls."""
    outcome = churn.select(
        "company_id",
        "days_to_hard_churn",
        "hard_churn_observed",
        "days_to_soft_decay",
        "soft_decay_observed",
        "is_treatment",
    )
    treated = pairs.select(F.col("treatment_company_id").alias("company_id"))
    control = pairs.select(F.col("control_company_id").alias("company_id"))
    return outcome.join(treated, "company_id", "left_semi").unionByName(
        outcome.join(control, "company_id", "left_semi")
    )


def matched_outcomes(cohort: DataFrame) -> DataFrame:
    return cohort.groupBy("is_treatment").agg(
        F.sum("hard_churn_observed").alias("events"), F.avg("days_to_hard_churn").alias("mean_days")
    )


def match_summary(scored: DataFrame, pairs: DataFrame) -> DataFrame:
    """Treated, matched and dropped counts with the mean score difference."""
    found = pairs.agg(F.struct(F.count(F.lit(1)).alias("n"), F.avg("ps_diff").alias("diff"))).scalar()
    return (
        scored.agg(F.count_if("is_treatment").alias("n_treated"))
        .withColumn("found", found)
        .select(
            "n_treated",
            F.col("found.n").alias("n_matched"),
            (F.col("n_treated") - F.col("found.n")).alias("n_dropped"),
            F.col("found.diff").alias("avg_ps_diff"),
        )
    )
