"""Data-quality checks; each returns one row with its number of violations. The names of the checks are fixed values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import business as B
from ..functions.numeric import ratio, round_to


def _check(rows: DataFrame, name: str, violations: Column) -> DataFrame:
    return rows.agg(violations.cast("long").alias("violations")).select(F.lit(name).alias("name"), "violations")


def check_unique_company(churn: DataFrame) -> DataFrame:
    """Rows beyond the first per company.

    Counted from per-company counts, which combine map-side, so no distinct set
    is built in one place.
    """
    per_company = churn.groupBy("company_id").agg(F.count(F.lit(1)).alias("n"))
    extra = F.coalesce(F.sum(F.when(F.col("company_id").isNull(), F.col("n")).otherwise(F.col("n") - 1)), F.lit(0))
    return _check(per_company, "No duplicate company_id in fct_cohort_churn", extra)


def check_exclusive_groups(churn: DataFrame) -> DataFrame:
    both = F.count_if(F.col("is_treatment") & F.col("is_control"))
    return _check(churn, "Treatment/control mutually exclusive", both)


def check_rowcount(features: DataFrame, companies: DataFrame) -> DataFrame:
    expected = companies.agg(F.count(F.lit(1))).scalar()
    found = features.agg(F.count(F.lit(1)).alias("found")).withColumn("expected", expected)
    return found.select(
        F.lit("fct_account_features row count matches companies").alias("name"),
        F.abs(F.col("found") - F.col("expected")).alias("violations"),
    )


def check_not_null(churn: DataFrame) -> DataFrame:
    return _check(churn, "No nulls in hard_churn_label", F.count_if(F.col("hard_churn_label").isNull()))


def check_unique_company_day(usage: DataFrame) -> DataFrame:
    """Rows beyond the first per company and day."""
    per_day = usage.groupBy("company_id", "date").agg(F.count(F.lit(1)).alias("n"))
    return _check(per_day, "daily_usage company x date uniqueness", F.coalesce(F.sum(F.col("n") - 1), F.lit(0)))


def orphan_check(usage: DataFrame, companies: DataFrame) -> DataFrame:
    """Distinct usage ids without a company."""
    ids = usage.select("company_id").distinct()
    orphans = ids.join(companies.select("company_id"), "company_id", "left_anti")
    return _check(orphans, "daily_usage orphan company_ids", F.count(F.lit(1)))


def table_profile(companies: DataFrame, usage: DataFrame, errors: DataFrame) -> DataFrame:
    """Row counts of the sources and the size and share of the two groups."""

    def size(rows: DataFrame, name: str) -> DataFrame:
        return rows.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("item"), "n", F.lit(None).cast("double").alias("pct")
        )

    treated = B.treatment_flag("infra_risk_score")
    n, n_t = F.count(F.lit(1)), F.count_if(treated)

    def group(name: str, count: Column) -> Column:
        return F.struct(
            F.lit(name).alias("item"), count.alias("n"), round_to(ratio(count, n) * 100.0, 1).alias("pct")
        )

    groups = companies.agg(F.array(group("treatment", n_t), group("control", n - n_t)).alias("g")).select(
        F.inline("g")
    )
    parts = [size(companies, "companies"), size(usage, "daily_usage"), size(errors, "api_errors"), groups]
    return reduce(DataFrame.unionByName, parts)


def quality_report(*checks: DataFrame) -> DataFrame:
    """All checks in one table with PASS or FAIL."""
    return reduce(DataFrame.unionByName, checks).withColumn(
        "status", F.when(F.col("violations") == 0, F.lit("PASS")).otherwise(F.lit("FAIL"))
    )


def observed_report(seen: dict[str, dict[str, int]], churn: DataFrame, companies: DataFrame, usage: DataFrame) -> DataFrame:
    """``quality_report`` of stored models from figures observed while they were written.

    Nulls, group flags and row counts cost no further pass. Uniqueness takes one aggregate over the stored facts
    (bucketed by company, so without an exchange) and one over the usage rows, which also gives the ids for the orphan check.
    """
    spark = churn.sparkSession
    days = usage.groupBy("company_id", "date").agg(F.count(F.lit(1)).alias("n"))
    ids = days.groupBy("company_id").agg((F.sum("n") - F.count(F.lit(1))).alias("extra"))
    known = companies.select("company_id", F.lit(True).alias("known")).distinct()
    of_usage = ids.join(known, "company_id", "left").agg(
        F.coalesce(F.sum("extra"), F.lit(0)).alias("extra"), F.count_if(F.col("known").isNull()).alias("orphans")
    ).first()
    distinct = churn.groupBy("company_id").agg(F.count(F.lit(1)).alias("n")).agg(F.count("company_id")).first()[0]
    facts, features = seen["churn"], seen["features"]
    counts = [
        ("No duplicate company_id in fct_cohort_churn", facts["rows"] - distinct),
        ("Treatment/control mutually exclusive", facts["both_groups"]),
        ("fct_account_features row count matches companies", abs(features["rows"] - companies.count())),
        ("No nulls in hard_churn_label", facts["no_label"]),
        ("daily_usage company x date uniqueness", of_usage["extra"]),
        ("daily_usage orphan company_ids", of_usage["orphans"]),
    ]
    return quality_report(spark.createDataFrame(counts, "name string, violations long"))
