"""One object that builds the models from the three sources, each at most once."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from ..sources import sinks
from . import models as M


class Pipeline:
    """Lazy lineage over ``companies``, ``usage`` and ``errors``.

    Every property is a plan, not data; persist one (``sources.sinks``) where
    several actions read it.
    """

    def __init__(
        self,
        companies: DataFrame,
        usage: DataFrame,
        errors: DataFrame,
        horizon: int = M.HORIZON_DAYS,
        hard_share: float = M.HARD_CHURN_SHARE,
        soft_share: float = M.SOFT_DECAY_SHARE,
    ) -> None:
        self.companies, self.usage, self.errors = companies, usage, errors
        self.horizon, self.hard_share, self.soft_share = horizon, hard_share, soft_share
        #: Figures observed while models were stored, by model.
        self.seen: dict[str, dict[str, int]] = {}

    @cached_property
    def stg_daily_usage(self) -> DataFrame:
        return M.stg_daily_usage(self.usage, self.companies)

    @cached_property
    def int_usage_velocity(self) -> DataFrame:
        return M.int_usage_velocity(self.stg_daily_usage)

    @cached_property
    def onboarding_errors(self) -> DataFrame:
        return M.onboarding_errors(self.errors, self.companies)

    @cached_property
    def int_friction_flags(self) -> DataFrame:
        return M.friction_flags(self.stg_daily_usage, self.onboarding_errors)

    @cached_property
    def int_cohort_health(self) -> DataFrame:
        return M.int_cohort_health(self.int_usage_velocity)

    @cached_property
    def account_rollup(self) -> DataFrame:
        return M.account_rollup(self.int_usage_velocity, self.hard_share, self.soft_share)

    @cached_property
    def fct_cohort_churn(self) -> DataFrame:
        return M.fct_cohort_churn(self.account_rollup, self.onboarding_errors, self.horizon)

    @cached_property
    def fct_account_features(self) -> DataFrame:
        return M.fct_account_features(self.account_rollup, self.onboarding_errors, self.horizon)

    def models(self) -> dict[str, DataFrame]:
        names = (
            "stg_daily_usage",
            "int_usage_velocity",
            "int_friction_flags",
            "int_cohort_health",
            "fct_cohort_churn",
            "fct_account_features",
        )
        return {name: getattr(self, name) for name in names}

    def persist(self, folder: str, buckets: int | None = None) -> Pipeline:
        """Store the models below ``folder`` and return a pipeline that reads them.

        Staging, velocity, the rollup, the counted onboarding errors and both fact tables are bucketed by company:
        what is built from them needs no exchange on that key. The usage series is joined with the accounts once and
        the error log is read once. Figures for the data-quality report come out of the same writes (``seen``).
        """
        stored = Pipeline(self.companies, self.usage, self.errors, self.horizon, self.hard_share, self.soft_share)

        def keep(name: str, model: DataFrame, *order: str) -> DataFrame:
            return sinks.store_bucketed(model, folder, name, "company_id", order, buckets)

        stored.stg_daily_usage = keep("stg_daily_usage", self.stg_daily_usage, "usage_date", "log_id")
        stored.int_usage_velocity = keep("int_usage_velocity", stored.int_usage_velocity, "usage_date", "log_id")
        stored.onboarding_errors = keep("onboarding_errors", self.onboarding_errors)
        stored.int_cohort_health = sinks.store(stored.int_cohort_health, folder, "int_cohort_health")
        stored.account_rollup = keep("account_rollup", stored.account_rollup)
        churn, of_churn = sinks.observed(
            stored.fct_cohort_churn, "churn", rows=F.count(F.lit(1)), no_label=F.count_if(F.col("hard_churn_label").isNull()),
            both_groups=F.count_if(F.col("is_treatment") & F.col("is_control")),
        )
        features, of_features = sinks.observed(stored.fct_account_features, "features", rows=F.count(F.lit(1)))
        stored.fct_cohort_churn = keep("fct_cohort_churn", churn)
        stored.fct_account_features = keep("fct_account_features", features)
        stored.seen = {"churn": of_churn.get, "features": of_features.get}
        return stored
