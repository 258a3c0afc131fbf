"""One named query per operator, each over the whole tables of a folder."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import business as B
from ..functions.numeric import round_to
from ..operators import attribution as A
from ..operators import behavior as H
from ..operators import boosting as G
from ..operators import causal as C
from ..operators import matching as X
from ..operators import metrics as Q
from ..operators import portfolio as P
from ..operators import quality as K
from ..operators import scoring as S
from ..operators import survival as V
from ..operators import whatif as W
from ..plans import models as M
from ..plans import refresh as R
from ..plans.pipeline import Pipeline
from ..session import materialize, scratch_path
from ..sources import readers, sinks, star
from ..sources.schemas import API_ERRORS

# The test tables cover 30 days.
HORIZON = 30
# For results past day 30, events are spread over three times as many days.
LONG_HORIZON = 90
_inputs: dict[tuple[str, str], Inputs] = {}
# What is fitted once for each application and folder.
_fitted: dict[tuple[str, str, str], object] = {}


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: round_to(c, digits) for c in columns})


def friction_risk(rows: DataFrame) -> DataFrame:
    """A fixed scorer of latency and 429 counts, in place of a trained model."""
    ttft = F.col("avg_ttft_ms_onboarding").cast("double")
    n429 = F.col("count_429_onboarding").cast("double")
    return rows.withColumn(
        "probability", F.least(F.lit(1.0), ttft / 800.0 + F.least(n429, F.lit(5.0)) * F.lit(0.1))
    )


def key_score(scale: int) -> Column:
    return ((F.col("company_id") * 7919) % scale).cast("double") / float(scale)


class Inputs:
    """Tables of one folder and the plans derived from them; plans only, no data."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return star.read_table(self.spark, self.folder, name)

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def companies(self) -> DataFrame:
        return star.companies(self.table("customer"), self.events)

    @cached_property
    def usage(self) -> DataFrame:
        return star.daily_usage(self.events)

    @cached_property
    def errors(self) -> DataFrame:
        return star.api_errors(self.events)

    @cached_property
    def pipe(self) -> Pipeline:
        return Pipeline(self.companies, self.usage, self.errors, horizon=HORIZON)

    @property
    def stg(self) -> DataFrame:
        return self.pipe.stg_daily_usage

    @property
    def velocity(self) -> DataFrame:
        return self.pipe.int_usage_velocity

    @property
    def weeks(self) -> DataFrame:
        return M.int_cohort_health(self.velocity, sort=False)

    @property
    def churn(self) -> DataFrame:
        return self.pipe.fct_cohort_churn

    @property
    def features(self) -> DataFrame:
        return self.pipe.fct_account_features

    @cached_property
    def matrix(self) -> DataFrame:
        """Features with missing numbers as 0; ids and names kept."""
        return self.features.fillna(0, subset=S.NUMERIC_FEATURES)

    @cached_property
    def scored(self) -> DataFrame:
        return S.scored_accounts(self.features.withColumn("probability", key_score(100)), sort=False)

    @cached_property
    def propensity(self) -> DataFrame:
        return self.features.withColumn("ps", key_score(1000))

    @property
    def pairs(self) -> DataFrame:
        return X.caliper_match(self.propensity, "ps")

    @cached_property
    def covariates(self) -> tuple[DataFrame, list[str]]:
        levels = C.industry_levels(self.companies)
        return C.psm_covariates(self.features, levels), C.covariate_names(levels)

    def once(self, name: str, build: Callable[[], object]):
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _fitted:
            _fitted[key] = build()
        return _fitted[key]

    @property
    def stored_features(self) -> DataFrame:
        """The feature table, computed once: fits, splits, scores and explanations read it in turn."""
        return self.once("features", lambda: materialize(self.features))

    @property
    def model(self) -> G.Forest:
        return self.once("model", lambda: G.train(self.stored_features))

    @property
    def holdout(self) -> DataFrame:
        """Scores of the model on the side of the split that it has not seen."""
        return self.once("holdout", lambda: materialize(G.holdout(self.stored_features, self.model)))

    @property
    def out_of_fold(self) -> DataFrame:
        return self.once("out_of_fold", lambda: materialize(G.out_of_fold(self.stored_features)))

    @property
    def model_scored(self) -> DataFrame:
        return S.scored_accounts(G.score(self.model, self.stored_features), sort=False)

    @property
    def fitted_propensity(self) -> DataFrame:
        return self.once("propensity", lambda: materialize(C.propensity_score(self.features)))

    @property
    def fitted_pairs(self) -> DataFrame:
        return self.once("pairs", lambda: materialize(X.caliper_match(self.fitted_propensity)))

    @cached_property
    def long(self) -> Inputs:
        return LongInputs(self.spark, self.folder)

    @property
    def loudest(self) -> int:
        """The account with most errors, the smallest id among equals."""
        counts = self.errors.groupBy("company_id").agg(F.count(F.lit(1)).alias("n"))
        return counts.orderBy(F.desc("n"), "company_id").first()["company_id"]


class LongInputs(Inputs):
    """The same tables with every third event a month later, and the next third two."""

    @cached_property
    def events(self) -> DataFrame:
        later = F.make_dt_interval(((F.col("event_id") % 3) * 30).cast("int"))
        return self.table("events").withColumn("ts", F.col("ts") + later)

    @cached_property
    def pipe(self) -> Pipeline:
        return Pipeline(self.companies, self.usage, self.errors, horizon=LONG_HORIZON)


# --------------------------------------------------------- sources and sinks


def read_source(i: Inputs) -> DataFrame:
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return readers.read_source(i.spark, f"{i.folder}/customer.parquet", schema, "parquet")


def read_dated(i: Inputs) -> DataFrame:
    folder = scratch_path(i.spark, "dated")
    paths = sinks.write_results({"fct_cohort_churn": i.churn}, folder, "csv")
    back = readers.read_dated(i.spark, paths["fct_cohort_churn"], i.churn.schema)
    return back.select(
        "company_id", "signup_date", "peak_date", "friction_bucket", "is_treatment", "days_to_hard_churn"
    )


def require_sources(i: Inputs) -> DataFrame:
    names = ("customer", "events")
    opened = readers.require_sources(i.spark, {n: f"{i.folder}/{n}.parquet" for n in names}, "parquet")
    counts = [
        opened[n].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("source"), "row_count")
        for n in names
    ]
    return counts[0].unionByName(counts[1])


def register_model(i: Inputs) -> DataFrame:
    # A name for each folder, so that one folder never replaces another's.
    name = f"stg_daily_usage_{zlib.crc32(i.folder.encode()):08x}"
    sinks.register_model(i.stg, name)
    return i.spark.sql(f"SELECT industry, count(*) AS n, sum(total_tokens) AS tokens FROM {name} GROUP BY industry")


def persist_model(i: Inputs) -> DataFrame:
    return sinks.row_counts(i.pipe.persist(scratch_path(i.spark, "models")).models())


def write_results(i: Inputs) -> DataFrame:
    results = {
        "psm_matched_cohort": C.matched_cohort(i.churn, i.pairs),
        "scored_accounts": i.scored,
        "counterfactual_scenarios": W.counterfactual_scenarios(i.matrix, friction_risk),
    }
    paths = sinks.write_results(results, scratch_path(i.spark, "results"))
    out = None
    for name, path in paths.items():
        row = i.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count"))
        row = row.select(F.lit(name).alias("result"), "row_count")
        out = row if out is None else out.unionByName(row)
    return out


def cache_model(i: Inputs) -> DataFrame:
    cached = sinks.cache_model(i.features)
    try:
        # One row per tier, stored while the cache is there; then the cache goes.
        return materialize(cached.groupBy("contract_tier").agg(F.count(F.lit(1)).alias("n")))
    finally:
        cached.unpersist()


def save_load_model(i: Inputs) -> DataFrame:
    path = G.save_forest(i.spark, i.model, scratch_path(i.spark, "churn_model"))
    return G.score(G.load_forest(i.spark, path), i.stored_features).select("company_id", round_to("probability", 6).alias("probability"))


# ------------------------------------------------------------- small views


def trained_scores(i: Inputs) -> DataFrame:
    return G.score(i.model, i.stored_features).select(
        "company_id", F.col("hard_churn_label").cast("int").alias("label"), round_to("probability", 6).alias("probability")
    )


def account_card(i: Inputs) -> DataFrame:
    """Scored accounts carry the signals too: they are derived once and stored, and both sides of the join read that table."""
    card = materialize(i.scored.drop("hard_churn_label", "days_to_hard_churn", "avg_tokens_days_0_14"))
    return P.account_card(card, card)


def attributions(i: Inputs) -> DataFrame:
    return A.attribution(i.model, i.stored_features)


# Certificates: what has to be zero, or a known count, for a fit whose numbers SQL cannot compute.


def zero(column: Column, digits: int = 6) -> Column:
    return F.abs(round_to(column, digits))


def train_certificate(i: Inputs) -> DataFrame:
    leaves = G.split_certificate(i.stored_features, i.model)
    return leaves.agg(zero(F.max(F.abs("residual"))).alias("worst_residual")).select(
        F.lit(len(i.model.value)).alias("trees"), "worst_residual"
    )


def save_load_certificate(i: Inputs) -> DataFrame:
    path = G.save_forest(i.spark, i.model, scratch_path(i.spark, "churn_model"))
    both = G.score(G.load_forest(i.spark, path), G.score(i.model, i.stored_features), "again")
    return both.select("company_id", zero(F.col("again") - F.col("probability")).alias("difference"))


def attribution_certificate(i: Inputs) -> DataFrame:
    margin = G.score(i.model, i.stored_features).select("company_id", F.log(F.col("probability") / (1.0 - F.col("probability"))).alias("log_odds"))
    parts = F.col("base_value")
    for c in S.FEATURES:
        parts = parts + F.col(c)
    return attributions(i).join(margin, "company_id").select("company_id", zero(parts - F.col("log_odds")).alias("residual"))


def top_features_certificate(i: Inputs) -> DataFrame:
    """Places of the listed features, and whether any other one has a larger mean."""
    means = materialize(A.feature_importance(attributions(i)))
    top = A.top_features(means)
    least = top.agg(F.min("mean_abs_attribution")).scalar()
    missed = means.join(top, "feature", "left_anti").where(F.col("mean_abs_attribution") > least)
    return top.agg(F.count(F.lit(1)).alias("listed")).withColumn("missed", missed.agg(F.count(F.lit(1))).scalar())


def cross_validate_certificate(i: Inputs) -> DataFrame:
    return i.out_of_fold.groupBy("fold", F.col("label").cast("int").alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if((F.col("probability") > 0) & (F.col("probability") < 1)).alias("n_scored")
    )


def propensity_certificate(i: Inputs) -> DataFrame:
    scaled, names, inputs = C.propensity_inputs(i.features)
    found = C.propensity_gradient(scaled, inputs, C.newton_propensity(scaled, inputs))
    return found.select(F.regexp_replace("covariate", "_z$", "").alias("covariate"), zero(F.col("gradient")).alias("gradient"))


def fitted_balance(i: Inputs) -> DataFrame:
    rows, names = i.covariates
    return C.balance_table(rows, i.fitted_pairs, names)


def smd(i: Inputs) -> DataFrame:
    rows, names = i.covariates
    return rounded(C.smd(rows, names), "smd")


def standardize(i: Inputs) -> DataFrame:
    rows, names = i.covariates
    scaled = C.standardize(rows, names)
    return scaled.select("company_id", *[round_to(f"{c}_z", 6).alias(f"{c.lower()}_z") for c in names])


def psm_covariates(i: Inputs) -> DataFrame:
    rows, names = i.covariates
    return rounded(rows.select("company_id", *[F.col(c).alias(c.lower()) for c in names]), *[c.lower() for c in names])


def balance_table(i: Inputs) -> DataFrame:
    rows, names = i.covariates
    return C.balance_table(rows, i.pairs, names)


def stratified_split(label: str) -> Callable[[Inputs], DataFrame]:
    def run(i: Inputs) -> DataFrame:
        return S.stratified_split(i.churn, label=label).groupBy(label).agg(
            F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("n_test")
        )

    return run


def class_weight(label: str) -> Callable[[Inputs], DataFrame]:
    def run(i: Inputs) -> DataFrame:
        split = S.stratified_split(i.churn, label=label)
        return rounded(S.class_weight(split.where(~F.col("is_test")), label), "weight")

    return run


def risk_overlay(i: Inputs) -> DataFrame:
    return P.risk_histogram_overlay(W.risk_overlay(i.matrix, friction_risk))


def quality_report(i: Inputs) -> DataFrame:
    return K.quality_report(
        K.check_unique_company(i.churn),
        K.check_exclusive_groups(i.churn),
        K.check_rowcount(i.features, i.companies),
        K.check_not_null(i.churn),
        K.check_unique_company_day(i.usage),
        K.orphan_check(i.usage, i.companies),
    )


def group_counts(i: Inputs) -> DataFrame:
    groups = {
        "is_treatment": H.group_counts(i.churn.withColumn("g", F.col("is_treatment").cast("string")), "g"),
        "risk_tier": H.group_counts(i.scored, "risk_tier"),
        "error_code": H.group_counts(i.errors.withColumn("g", F.col("error_code").cast("string")), "g"),
    }
    out = None
    for name, counts in groups.items():
        part = counts.select(F.lit(name).alias("column_name"), "value", "n")
        out = part if out is None else out.unionByName(part)
    return out


def all_accounts(i: Inputs) -> DataFrame:
    return i.churn


def matched_accounts(i: Inputs) -> DataFrame:
    return C.matched_cohort(i.churn, i.pairs)


def fitted_match(i: Inputs) -> DataFrame:
    return C.matched_cohort(i.churn, i.fitted_pairs)


Rows = Callable[["Inputs"], DataFrame]


def survival(kind: tuple[str, str], part: str, rows: Rows = all_accounts) -> Callable[[Inputs], DataFrame]:
    def run(i: Inputs) -> DataFrame:
        curve = V.km_curve(rows(i), *kind)
        if part == "curve":
            return rounded(curve, "survival")
        if part == "band":
            return rounded(V.km_confidence(curve), "survival", "lower_95", "upper_95")
        return V.km_median(curve)

    return run


def logrank(kind: tuple[str, str], rows: Rows = all_accounts) -> Callable[[Inputs], DataFrame]:
    def run(i: Inputs) -> DataFrame:
        return rounded(V.logrank_test(rows(i), *kind), "expected", "variance", "chi2", "p_value")

    return run


def feature_matrix(i: Inputs) -> DataFrame:
    matrix = S.feature_matrix(i.features)
    return matrix.select("company_id", F.col("label").cast("int").alias("label"), *S.FEATURES)


REGISTRY: dict[str, Callable[[Inputs], DataFrame]] = {
    # sources and sinks
    "read_source": read_source,
    "read_dated": read_dated,
    "require_sources": require_sources,
    "register_model": register_model,
    "persist_model": persist_model,
    "write_results": write_results,
    "cache_model": cache_model,
    "save_load_model": save_load_model,
    # projections and predicates
    "stg_daily_usage": lambda i: i.stg,
    "cache_ratio": lambda i: i.usage.select("log_id", B.cache_ratio("prompt_cached_tokens", "input_tokens").alias("r")),
    "onboarding_flag": lambda i: i.stg.select("log_id", "is_onboarding_window"),
    "day_since_signup": lambda i: i.stg.select("log_id", "day_since_signup"),
    "pct_change": lambda i: i.velocity.select("log_id", "dod_token_delta", "dod_pct_change", "wow_pct_change"),
    "treatment_flag": lambda i: i.companies.select(
        "company_id", B.treatment_flag("infra_risk_score").alias("is_treatment")
    ),
    "friction_bucket": lambda i: i.pipe.int_friction_flags.select("company_id", "friction_bucket"),
    "control_flag": lambda i: i.churn.select("company_id", "is_control"),
    "retention_ratios": lambda i: i.weeks.select(
        "company_id", "week_num", "retention_vs_peak", "wow_retention_rate"
    ),
    "peak_week_flag": lambda i: i.weeks.select("company_id", "week_num", "is_peak_week"),
    "churn_labels": lambda i: i.churn.select(
        "company_id",
        "hard_churn_label",
        "soft_decay_label",
        "days_to_hard_churn",
        "days_to_soft_decay",
        "hard_churn_observed",
        "soft_decay_observed",
    ),
    "momentum_ratio": lambda i: i.features.select("company_id", "token_momentum_w2_vs_w1"),
    "null_to_zero": lambda i: i.matrix.select("company_id", *S.NUMERIC_FEATURES),
    "day_bin": lambda i: i.stg.select("log_id", B.day_bin("day_since_signup").alias("day_bin")),
    "risk_tier": lambda i: i.scored.select("company_id", "risk_tier"),
    "prescribe": lambda i: S.prescribe(i.features).select(
        "company_id", "top_friction_trigger", "recommended_action", "action_owner"
    ),
    "arr_value": lambda i: i.companies.select("company_id", B.arr_value("contract_tier").alias("arr_value")),
    "perturb_features": lambda i: rounded(
        W.perturb_features(i.matrix, 0.75, 0.5).select(
            "company_id",
            "avg_ttft_ms_onboarding",
            "max_ttft_ms_onboarding",
            "avg_ttft_days_0_14",
            "max_ttft_days_0_14",
            "count_429_onboarding",
            "count_500_onboarding",
        ),
        "avg_ttft_ms_onboarding",
        "max_ttft_ms_onboarding",
        "avg_ttft_days_0_14",
        "max_ttft_days_0_14",
    ),
    "alert_feed": lambda i: P.alert_feed(i.scored),
    "format_display": lambda i: P.format_display(i.scored),
    "account_usage": lambda i: P.account_usage(i.stg),
    "account_errors": lambda i: P.account_errors(i.errors),
    "account_card": account_card,
    "account_directory": lambda i: P.account_directory(i.scored),
    # joins
    "usage_join_company": lambda i: i.stg.select("log_id", "company_id", "company_name", "industry", "contract_tier"),
    "errors_join_signup": lambda i: H.errors_join_signup(i.errors, i.companies),
    "friction_join_errors": lambda i: i.pipe.int_friction_flags.select(
        "company_id",
        "onboarding_days_active",
        *[f"count_{code}_onboarding" for code in M.ERROR_CODES],
        "total_errors_onboarding",
    ),
    "first_peak_date": lambda i: M.first_peak_date(i.velocity),
    "post_peak_scan": lambda i: M.post_peak_scan(i.velocity).select(
        "company_id", "usage_date", "rolling_7d_avg_tokens", "peak_rolling_avg", "peak_date"
    ),
    "fct_cohort_churn": lambda i: i.churn,
    "fct_account_features": lambda i: i.features,
    "usage_join_onset": lambda i: H.usage_join_onset(i.stg, i.churn),
    "usage_join_bucket": lambda i: H.usage_join_bucket(i.stg, i.churn),
    "errors_join_signup_day": lambda i: H.errors_join_signup_day(i.errors, i.companies),
    "group_semi_join": lambda i: H.group_semi_join(i.stg, i.churn, treated=True).select("log_id", "company_id"),
    "orphan_check": lambda i: K.orphan_check(i.usage, i.companies),
    "caliper_match": lambda i: i.pairs,
    "scenario_cross": lambda i: rounded(
        W.scenario_cross(i.matrix).select(
            "company_id", "scenario", "avg_ttft_ms_onboarding", "max_ttft_days_0_14", "count_429_onboarding"
        ),
        "avg_ttft_ms_onboarding",
        "max_ttft_days_0_14",
    ),
    # aggregations
    "onboarding_usage": lambda i: M.onboarding_usage(i.stg),
    "onboarding_errors": lambda i: i.pipe.onboarding_errors,
    "error_pivot": lambda i: M.error_pivot(i.pipe.onboarding_errors),
    "int_friction_flags": lambda i: i.pipe.int_friction_flags,
    "weekly_tokens": lambda i: rounded(M.weekly_tokens(i.velocity), "avg_weekly_tokens"),
    "peak_per_company": lambda i: M.peak_per_company(i.velocity),
    "churn_onset": lambda i: M.churn_onset(i.velocity),
    "velocity_trends": lambda i: M.velocity_trends(i.velocity),
    "growth_slope": lambda i: rounded(M.growth_slope(i.velocity), "token_growth_slope_onboarding"),
    "churn_by_group": lambda i: H.churn_by_group(i.churn),
    "cohort_overview": lambda i: rounded(H.cohort_overview(i.churn), "avg_onset_treatment"),
    "churn_by_day": lambda i: H.churn_by_day(i.churn, (10, 20, 30)),
    "cumulative_churn": lambda i: rounded(H.cumulative_churn(i.churn), "cumulative_pct"),
    "onset_histogram": lambda i: rounded(H.onset_histogram(i.churn), "bin_start", "bin_end", "median_onset"),
    "median_onset": lambda i: rounded(H.median_onset(i.churn), "median_onset_days"),
    "pre_churn_curve": lambda i: rounded(H.pre_churn_curve(i.stg, i.churn), "avg_tokens"),
    "control_baseline": lambda i: rounded(H.control_baseline(i.stg, i.churn), "control_avg_tokens"),
    "cohort_heatmap": lambda i: rounded(H.cohort_heatmap(i.stg, i.churn), *H.HEATMAP_COLUMNS),
    "heatmap_relative": lambda i: rounded(
        H.heatmap_relative(H.cohort_heatmap(i.stg, i.churn)), *H.HEATMAP_COLUMNS
    ),
    "heatmap_finding": lambda i: rounded(
        H.heatmap_finding(H.cohort_heatmap(i.stg, i.churn)), "severe_drop_pct", "none_growth_pct"
    ),
    "errors_by_onboarding_day": lambda i: H.errors_by_onboarding_day(i.errors, i.churn),
    "ttft_by_day_group": lambda i: rounded(H.ttft_by_day_group(i.stg, i.churn), "avg_ttft_ms"),
    "churn_by_industry": lambda i: rounded(H.churn_by_industry(i.churn), "treatment", "control"),
    "time_to_churn_by_tier": lambda i: rounded(H.time_to_churn_by_tier(i.churn), "mean_days", "std_days"),
    "propensity_summary": lambda i: rounded(
        C.propensity_summary(i.propensity, "ps"), "mean", "std", "min", "q_25", "q_50", "q_75", "max"
    ),
    "propensity_overlap": lambda i: rounded(
        C.propensity_overlap(i.propensity, "ps"), "range_min", "range_max", "bin_start", "density"
    ),
    "group_counts": group_counts,
    "match_summary": lambda i: rounded(C.match_summary(i.propensity, i.pairs), "avg_ps_diff"),
    "matched_outcomes": lambda i: rounded(
        C.matched_outcomes(C.matched_cohort(i.churn, i.pairs)), "mean_days"
    ),
    "portfolio_kpis": lambda i: P.portfolio_kpis(i.scored),
    "risk_histogram": lambda i: P.risk_histogram(i.scored),
    "risk_histogram_overlay": risk_overlay,
    "risk_by_industry": lambda i: rounded(P.risk_by_industry(i.scored), "avg_churn_probability"),
    "account_errors_by_code": lambda i: P.account_errors_by_code(i.errors),
    "account_429_daily": lambda i: P.account_429_daily(i.errors),
    "account_ttft_vs_portfolio": lambda i: rounded(P.account_ttft_vs_portfolio(i.stg), "portfolio_avg_ttft"),
    # windows
    "rolling_7d_avg": lambda i: i.velocity.select("log_id", "company_id", "usage_date", "rolling_7d_avg_tokens"),
    "prev_day_tokens": lambda i: M.with_lags(i.stg).select("log_id", "total_tokens", "prev_day_tokens"),
    "tokens_7d_ago": lambda i: M.with_lags(i.stg).select("log_id", "total_tokens", "tokens_7d_ago"),
    "int_usage_velocity": lambda i: i.velocity,
    "peak_weekly_tokens": lambda i: i.weeks.select("company_id", "week_num", "peak_weekly_tokens"),
    "prev_week_tokens": lambda i: rounded(
        M.weekly_with_peak(i.velocity).select("company_id", "week_num", "prev_week_tokens"), "prev_week_tokens"
    ),
    "int_cohort_health": lambda i: i.pipe.int_cohort_health,
    "account_rolling": lambda i: rounded(P.account_rolling(i.stg), "rolling_7d"),
    # sorts and top-k
    "sort_cohort": lambda i: i.pipe.int_cohort_health.select("company_id", "week_num", "avg_weekly_tokens"),
    "sort_scored": lambda i: i.scored.orderBy(F.desc("churn_probability"), "company_id").select(
        "company_id", "churn_probability"
    ),
    "top_features": lambda i: A.top_features(A.feature_importance(attributions(i))),
    "sort_saved": lambda i: W.saved_accounts(i.matrix, friction_risk).select("company_id", "baseline_risk"),
    # set operations
    "matched_cohort": lambda i: C.matched_cohort(i.churn, i.pairs),
    "distinct_signups": lambda i: H.distinct_signups(i.stg),
    # causal and survival
    "psm_covariates": psm_covariates,
    "standardize": standardize,
    "propensity_score": lambda i: i.fitted_propensity.select(
        "company_id", round_to("propensity_score", 6).alias("propensity_score")
    ),
    "smd": smd,
    "balance_table": balance_table,
    "km_curve_hard": survival(V.HARD, "curve"),
    "km_curve_soft": survival(V.SOFT, "curve"),
    "km_confidence_hard": survival(V.HARD, "band"),
    "km_confidence_soft": survival(V.SOFT, "band"),
    "km_median_hard": survival(V.HARD, "median"),
    "km_median_soft": survival(V.SOFT, "median"),
    "logrank_test_hard": logrank(V.HARD),
    "logrank_test_soft": logrank(V.SOFT),
    # scoring and what-if
    "encode_labels": lambda i: S.encode_labels(i.features).select(
        "company_id", F.col("industry_enc").cast("int"), F.col("contract_tier_enc").cast("int")
    ),
    "feature_matrix": feature_matrix,
    "stratified_split": stratified_split("soft_decay_label"),
    "stratified_split_hard": stratified_split("hard_churn_label"),
    "class_weight": class_weight("soft_decay_label"),
    "class_weight_hard": class_weight("hard_churn_label"),
    "train_churn_model": trained_scores,
    "cross_validate": lambda i: rounded(G.fold_metrics(i.out_of_fold), "mean_auc", "std_auc", "out_of_fold_auc"),
    "roc_auc": lambda i: rounded(Q.roc_auc(i.scored, "churn_probability", "hard_churn_label"), "roc_auc"),
    "average_precision": lambda i: rounded(
        Q.average_precision(i.scored, "churn_probability", "hard_churn_label"), "average_precision"
    ),
    "roc_pr_curves": lambda i: rounded(
        Q.roc_pr_curves(i.scored, "churn_probability", "hard_churn_label"), "fpr", "tpr", "precision", "recall"
    ),
    "classification_report": lambda i: rounded(
        Q.classification_report(i.scored, "churn_probability", "hard_churn_label"), "precision", "recall", "f1"
    ),
    "confusion_matrix": lambda i: Q.confusion_matrix(i.scored, "churn_probability", "hard_churn_label"),
    "attribution": attributions,
    "scored_accounts": lambda i: S.scored_accounts(i.features.withColumn("probability", key_score(100))),
    "counterfactual_scenarios": lambda i: W.counterfactual_scenarios(i.matrix, friction_risk),
    "what_if": lambda i: W.what_if(i.matrix, friction_risk, 30, 20, 100_000, 30_000),
    "saved_accounts": lambda i: W.saved_accounts(i.matrix, friction_risk),
    # data quality
    "check_unique_company": lambda i: K.check_unique_company(i.churn),
    "check_exclusive_groups": lambda i: K.check_exclusive_groups(i.churn),
    "check_rowcount": lambda i: K.check_rowcount(i.features, i.companies),
    "check_not_null": lambda i: K.check_not_null(i.churn),
    "check_unique_company_day": lambda i: K.check_unique_company_day(i.usage),
    "table_profile": lambda i: K.table_profile(i.companies, i.usage, i.errors),
    "quality_report": quality_report,
}



def faulty(i: Inputs) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fact rows, features and usage with violations of every check, by remainders of the account id."""
    company = F.col("company_id")
    churn = i.churn.withColumn("is_control", F.when(company % 5 == 0, F.lit(True)).otherwise(F.col("is_control")))
    churn = churn.withColumn("hard_churn_label", F.when(company % 11 != 0, F.col("hard_churn_label")))
    churn = churn.unionByName(churn.where(company % 7 == 0))
    usage = i.usage.unionByName(i.usage.where(company % 17 == 0)).unionByName(
        i.usage.where(company % 19 == 0).withColumn("company_id", company + 1_000_000)
    )
    return churn, i.features.where(company % 13 != 0), usage


def quality_report_faulty(i: Inputs) -> DataFrame:
    churn, features, usage = faulty(i)
    return K.quality_report(
        K.check_unique_company(churn), K.check_exclusive_groups(churn), K.check_rowcount(features, i.companies),
        K.check_not_null(churn), K.check_unique_company_day(usage), K.orphan_check(usage, i.companies),
    )


def quality_report_observed(i: Inputs) -> DataFrame:
    stored = i.pipe.persist(scratch_path(i.spark, "models"))
    return K.observed_report(stored.seen, stored.fct_cohort_churn, i.companies, i.usage)


def refresh_velocity(i: Inputs) -> DataFrame:
    """Velocity after three loads: early days without every ninth row and with wrong tokens in every tenth, then both mended, then late days."""
    folder = scratch_path(i.spark, "refreshed")
    late = F.col("date") >= F.lit("2024-01-21").cast("date")
    early, key = i.usage.where(~late), F.col("log_id")
    wrong = early.where(key % 9 != 0).withColumn(
        "input_tokens", F.when(key % 10 == 0, F.col("input_tokens") + 1).otherwise(F.col("input_tokens"))
    )
    R.build(wrong, i.companies, folder)
    R.refresh(early.where((key % 9 == 0) | (key % 10 == 0)), i.companies, folder)
    R.refresh(i.usage.where(late), i.companies, folder)
    return R.velocity(i.spark, folder).select(*i.velocity.columns)


def publish_results(i: Inputs) -> DataFrame:
    """Rows of the last committed version, after two commits."""
    folder = scratch_path(i.spark, "published")
    sinks.publish_results({"scored_accounts": i.scored.limit(0)}, folder)
    sinks.publish_results({"scored_accounts": i.scored, "fct_cohort_churn": i.churn}, folder)
    out = None
    for name in sorted(sinks.published_paths(i.spark, folder)):
        row = sinks.published(i.spark, folder, name).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("result"), "row_count")
        out = row if out is None else out.unionByName(row)
    return out


def sift_source(i: Inputs) -> DataFrame:
    """Good and bad rows, by reason, of the error log as CSV with faults in every 50th field."""
    number = F.col("error_id")
    code = F.when(number % 50 == 0, F.lit("none")).otherwise(F.col("error_code").cast("string"))
    line = F.concat_ws(",", number.cast("string"), F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"), F.col("company_id").cast("string"), code, "endpoint")
    line = F.when(number % 50 == 1, F.concat(line, F.lit(",more"))).when(number % 50 == 2, F.substring_index(line, ",", 3)).otherwise(line)
    path = scratch_path(i.spark, "damaged")
    written = i.errors.select(line.alias("error_id,timestamp,company_id,error_code,endpoint"))
    # One column per line: with another separator, commas are written as they are.
    written.write.option("header", True).option("sep", "\u0001").csv(path)
    sifted = readers.sift_source(i.spark, path, API_ERRORS)
    kind = F.regexp_replace("reason", ": .*", "")
    return sifted.good.agg(F.lit("good").alias("kind"), F.count(F.lit(1)).alias("n")).unionByName(
        sifted.bad.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    )


def by_group(kind_name: str, kind: tuple[str, str], where: str, rows: Rows) -> dict[str, Callable[[Inputs], DataFrame]]:
    return {
        f"km_curve_{where}_{kind_name}": survival(kind, "curve", rows),
        f"km_confidence_{where}_{kind_name}": survival(kind, "band", rows),
        f"km_median_{where}_{kind_name}": survival(kind, "median", rows),
        f"logrank_test_{where}_{kind_name}": logrank(kind, rows),
    }


ACCOUNT_VIEWS: dict[str, Callable[[Inputs, int], DataFrame]] = {
    "account_usage_one": lambda i, a: P.account_usage(i.stg, a),
    "account_errors_one": lambda i, a: P.account_errors(i.errors, a),
    "account_card_one": lambda i, a: P.account_card(i.scored, i.features, a),
    "account_errors_by_code_one": lambda i, a: P.account_errors_by_code(i.errors, a),
    "account_429_daily_one": lambda i, a: P.account_429_daily(i.errors, a),
    "account_ttft_vs_portfolio_one": lambda i, a: rounded(P.account_ttft_vs_portfolio(i.stg, a), "portfolio_avg_ttft"),
    "account_rolling_one": lambda i, a: rounded(P.account_rolling(i.stg, a), "rolling_7d"),
}

REGISTRY |= {
    # the fitted model on the side it has not seen
    "holdout_roc_auc": lambda i: rounded(Q.roc_auc(i.holdout, "probability", "label"), "roc_auc"),
    "holdout_average_precision": lambda i: rounded(
        Q.average_precision(i.holdout, "probability", "label"), "average_precision"
    ),
    "holdout_roc_pr_curves": lambda i: rounded(
        Q.roc_pr_curves(i.holdout, "probability", "label"), "threshold", "fpr", "tpr", "precision", "recall"
    ),
    "holdout_classification_report": lambda i: rounded(
        Q.classification_report(i.holdout, "probability", "label"), "precision", "recall", "f1"
    ),
    "holdout_confusion_matrix": lambda i: Q.confusion_matrix(i.holdout, "probability", "label"),
    # accounts and scenarios scored by the fitted model
    "model_scored_accounts": lambda i: i.model_scored.orderBy(F.desc("churn_probability"), "company_id"),
    "model_portfolio_kpis": lambda i: P.portfolio_kpis(i.model_scored),
    "model_alert_feed": lambda i: P.alert_feed(i.model_scored),
    "model_counterfactual_scenarios": lambda i: W.counterfactual_scenarios(i.stored_features, G.ForestScorer(i.model)),
    "model_what_if": lambda i: W.what_if(i.stored_features, G.ForestScorer(i.model), 30, 20, 100_000, 30_000),
    "model_saved_accounts": lambda i: W.saved_accounts(i.stored_features, G.ForestScorer(i.model)),
    # certificates of fits
    "train_churn_model_certificate": train_certificate,
    "save_load_model_certificate": save_load_certificate,
    "cross_validate_certificate": cross_validate_certificate,
    "attribution_certificate": attribution_certificate,
    "top_features_certificate": top_features_certificate,
    "propensity_score_certificate": propensity_certificate,
    # the causal chain from the fitted propensity score
    "fitted_propensity_summary": lambda i: rounded(
        C.propensity_summary(i.fitted_propensity), "mean", "std", "min", "q_25", "q_50", "q_75", "max"
    ),
    "fitted_propensity_overlap": lambda i: rounded(
        C.propensity_overlap(i.fitted_propensity), "range_min", "range_max", "bin_start", "density"
    ),
    "fitted_caliper_match": lambda i: rounded(i.fitted_pairs, "treatment_ps", "control_ps", "ps_diff"),
    "fitted_match_summary": lambda i: rounded(C.match_summary(i.fitted_propensity, i.fitted_pairs), "avg_ps_diff"),
    "fitted_balance_table": fitted_balance,
    "fitted_matched_outcomes": lambda i: rounded(C.matched_outcomes(fitted_match(i)), "mean_days"),
    # survival of matched accounts
    **by_group("hard", V.HARD, "matched", matched_accounts),
    **by_group("soft", V.SOFT, "matched", matched_accounts),
    **by_group("hard", V.HARD, "fitted", fitted_match),
    **by_group("soft", V.SOFT, "fitted", fitted_match),
    # storage
    "quality_report_observed": quality_report_observed,
    "quality_report_faulty": quality_report_faulty,
    "refresh_velocity": refresh_velocity,
    "publish_results": publish_results,
    "sift_source": sift_source,
    # one account, chosen by the data; the feed with both filters
    **{name: (lambda i, view=view: view(i, i.loudest)) for name, view in ACCOUNT_VIEWS.items()},
    "alert_feed_filtered": lambda i: P.alert_feed(i.scored, tiers=("Enterprise",), industries=("BUILDING", "MACHINERY")),
    # three months of usage
    "fct_cohort_churn_90": lambda i: i.long.churn,
    "velocity_trends_90": lambda i: M.velocity_trends(i.long.velocity),
    "cohort_heatmap_90": lambda i: rounded(H.cohort_heatmap(i.long.stg, i.long.churn), *H.HEATMAP_COLUMNS),
    "heatmap_relative_90": lambda i: rounded(
        H.heatmap_relative(H.cohort_heatmap(i.long.stg, i.long.churn)), *H.HEATMAP_COLUMNS
    ),
    "heatmap_finding_90": lambda i: rounded(
        H.heatmap_finding(H.cohort_heatmap(i.long.stg, i.long.churn)), "severe_drop_pct", "none_growth_pct"
    ),
}


def inputs(spark: SparkSession, folder: str) -> Inputs:
    """The plans of a folder, built once per application: building is slow, lazy work."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _inputs or _inputs[key].spark is not spark:
        _inputs[key] = Inputs(spark, folder)
    return _inputs[key]


def bind(name: str) -> Callable[[SparkSession, str], DataFrame]:
    build = REGISTRY[name]

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(inputs(spark, folder))

    run.__name__ = name
    return run
