import datetime as dt

import pytest

from usagetide.sources import readers, sinks
from usagetide.sources.schemas import API_ERRORS, COMPANIES


def test_csv_round_trip_keeps_types_and_the_word_none(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", "None", dt.date(2024, 1, 2), None, 0.1), ("b", "Mild", None, True, 1 / 3)],
        "company_id string, friction_bucket string, peak_date date, flag boolean, x double",
    )
    paths = sinks.write_results({"t": df}, str(tmp_path), "csv")
    back = readers.read_dated(spark, paths["t"], df.schema)
    assert set(back.collect()) == set(df.collect())


def test_missing_source_fails_with_its_name(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="api_errors"):
        readers.require_sources(spark, {"api_errors": str(tmp_path / "none")})


def test_csv_needs_a_schema_and_rejects_bad_fields(spark, tmp_path):
    with pytest.raises(ValueError):
        readers.read_source(spark, str(tmp_path))
    path = tmp_path / "e.csv"
    path.write_text("error_id,timestamp,company_id,error_code,endpoint\ne,2024-01-01 10:00:00,a,x,/v1\n")
    with pytest.raises(Exception):
        readers.read_source(spark, str(path), API_ERRORS).collect()


def test_registered_name_is_usable_from_sql(spark):
    df = spark.createDataFrame([("a", "A", "Tech", "Growth", dt.date(2024, 1, 1), 0.5, 0.5)], COMPANIES)
    sinks.register_model(df, "companies_t")
    assert spark.sql("SELECT count(*) FROM companies_t").first()[0] == 1


def test_persisted_and_counted(spark, tmp_path):
    models = {
        "stg_daily_usage": sinks.store(spark.range(3).toDF("x"), str(tmp_path), "stg_daily_usage"),
        "int_usage_velocity": spark.range(5).toDF("x"),
    }
    got = {r["model"]: (r["persisted"], r["row_count"]) for r in sinks.row_counts(models).collect()}
    assert got == {"stg_daily_usage": (True, 3), "int_usage_velocity": (False, 5)}
    assert sinks.load_model_table(spark, str(tmp_path), "stg_daily_usage").count() == 3
