"""Source tables derived from a customer dimension and an event stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def companies(customer: DataFrame, events: DataFrame) -> DataFrame:
    """One row per customer that has events.

    The event side is reduced to distinct ids before the semi join, so a
    customer with very many events puts no more than one row in the shuffle
    per map task.
    """
    active = events.select(F.col("user_id").alias("c_custkey")).distinct()
    key = F.col("c_custkey")
    return customer.join(active, "c_custkey", "left_semi").select(
        key.alias("company_id"),
        F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("industry"),
        F.when(F.col("c_acctbal") >= 5000, F.lit("Enterprise")).otherwise(F.lit("Growth")).alias("contract_tier"),
        F.date_add(F.lit("2024-01-01").cast("date"), (key % 10).cast("int")).alias("signup_date"),
        (F.lit(0.3) + (key % 10).cast("double") * F.lit(0.09)).alias("growth_rate"),
        (((key * 37) % 100).cast("double") / 100.0).alias("infra_risk_score"),
    )


def daily_usage(events: DataFrame) -> DataFrame:
    """Token counts per customer and day, in whole hundredths of the event value."""
    kind = F.col("event_type")
    ev = events.select(
        "event_id",
        F.col("user_id").alias("company_id"),
        F.col("ts").cast("date").alias("date"),
        kind,
        F.round(F.col("value") * 100.0, 0).cast("long").alias("cents"),
        _k().alias("k"),
    )

    def cents_of(*kinds: str) -> Column:
        return F.sum(F.when(kind.isin(*kinds), F.col("cents")).otherwise(F.lit(0)))

    return ev.groupBy("date", "company_id").agg(
        F.min("event_id").alias("log_id"),
        F.sum("cents").alias("input_tokens"),
        cents_of("view", "click").alias("output_tokens"),
        cents_of("view").alias("prompt_cached_tokens"),
        ((F.sum("k") * 8).cast("double") / F.count(F.lit(1))).alias("avg_ttft_ms"),
        (F.max("k").cast("double") / 100.0).alias("max_context_saturation_pct"),
    ).select(
        "log_id", "date", "company_id", "input_tokens", "output_tokens", "prompt_cached_tokens",
        "avg_ttft_ms", "max_context_saturation_pct",
    )


def api_errors(events: DataFrame) -> DataFrame:
    k = _k()
    code = F.element_at(F.array(F.lit(429), F.lit(500), F.lit(503), F.lit(400)), (k % 4) + 1)
    return events.where(F.col("event_type") == "error").select(
        F.col("event_id").alias("error_id"),
        F.col("ts").alias("timestamp"),
        F.col("user_id").alias("company_id"),
        code.alias("error_code"),
        F.when(k < 50, F.lit("/v1/messages")).otherwise(F.lit("/v1/embeddings")).alias("endpoint"),
    )
