"""Explicit schemas of the three source tables and the dated models."""

from __future__ import annotations

from pyspark.sql import types as T

COMPANIES = T.StructType(
    [
        T.StructField("company_id", T.StringType()),
        T.StructField("company_name", T.StringType()),
        T.StructField("industry", T.StringType()),
        T.StructField("contract_tier", T.StringType()),
        T.StructField("signup_date", T.DateType()),
        T.StructField("growth_rate", T.DoubleType()),
        T.StructField("infra_risk_score", T.DoubleType()),
    ]
)

DAILY_USAGE = T.StructType(
    [
        T.StructField("log_id", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("company_id", T.StringType()),
        T.StructField("input_tokens", T.IntegerType()),
        T.StructField("output_tokens", T.IntegerType()),
        T.StructField("prompt_cached_tokens", T.IntegerType()),
        T.StructField("avg_ttft_ms", T.DoubleType()),
        T.StructField("max_context_saturation_pct", T.DoubleType()),
    ]
)

API_ERRORS = T.StructType(
    [
        T.StructField("error_id", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("company_id", T.StringType()),
        T.StructField("error_code", T.IntegerType()),
        T.StructField("endpoint", T.StringType()),
    ]
)

SOURCES = {"companies": COMPANIES, "daily_usage": DAILY_USAGE, "api_errors": API_ERRORS}
