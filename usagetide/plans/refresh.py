"""Refresh of changed days in a day-partitioned store of the usage models.

``stg_daily_usage`` and ``int_usage_velocity`` lie below a folder, partitioned by ``usage_date``. New, corrected
and late rows replace what the store has for the same account and day. A velocity row depends on itself and the
seven rows of its account before it, so a changed row concerns itself and the next seven. Only days that hold
such rows are written again, by dynamic partition overwrite; all other partitions stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import materialize
from . import models as M

STAGED, VELOCITY = "stg_daily_usage", "int_usage_velocity"
DAY = "usage_date"
#: Rows before a row that its velocity looks at.
CONTEXT = 7


def _write_days(rows: DataFrame, path: str) -> None:
    """Replace exactly the days that ``rows`` has. Each day's rows go to tasks by company, so a busy day is no single task."""
    placed = rows.repartition(DAY, F.pmod(F.xxhash64("company_id"), F.lit(8)))
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def _read(spark: SparkSession, folder: str, name: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(f"{folder}/{name}").select(*like.columns)


def staged(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{STAGED}")


def velocity(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{VELOCITY}")


def build(usage: DataFrame, companies: DataFrame, folder: str) -> None:
    """The whole store from all usage rows."""
    rows = M.stg_daily_usage(usage, companies)
    _write_days(rows, f"{folder}/{STAGED}")
    stored = _read(usage.sparkSession, folder, STAGED, rows)
    _write_days(M.int_usage_velocity(stored), f"{folder}/{VELOCITY}")


def _replaced(old: DataFrame, new: DataFrame) -> DataFrame:
    """``old`` without the accounts and days that ``new`` has, and ``new``."""
    return old.join(new.select("company_id", DAY).distinct(), ["company_id", DAY], "left_anti").select(*old.columns).unionByName(new)


def refresh(changed: DataFrame, companies: DataFrame, folder: str) -> DataFrame:
    """Bring the store up to date with ``changed`` usage rows; returns the days of each model that were written again.

    ``changed`` has all rows, in full, of every account and day that is new or corrected, in any order and of any age. Running it
    twice, or again after a failure, leaves the same store. Attributes of accounts are taken as of now for changed rows.
    """
    spark = changed.sparkSession
    new = materialize(M.stg_daily_usage(changed, companies))
    before = _read(spark, folder, STAGED, new)
    days = new.select(DAY).distinct()  # a few dates
    merged = materialize(_replaced(before.join(F.broadcast(days), DAY, "left_semi").select(*before.columns), new))

    # Per account: rows from the first changed day on, and the seven before it.
    first = new.groupBy("company_id").agg(F.min(DAY).alias("first_day"))
    series = _replaced(before.join(first.select("company_id"), "company_id", "left_semi").select(*before.columns), new)
    back = Window.partitionBy("company_id").orderBy(F.desc(DAY), F.desc("log_id"))
    dated = series.join(first, "company_id")
    context = dated.where(F.col(DAY) < F.col("first_day")).withColumn("age", F.row_number().over(back)).where(F.col("age") <= CONTEXT)
    near = dated.where(F.col(DAY) >= F.col("first_day")).select(*before.columns).unionByName(context.select(*before.columns))
    near = materialize(near)
    moved = M.int_usage_velocity(near)
    keys = new.select("company_id", DAY).distinct().withColumn("is_new", F.lit(1))
    reach = M.company_days().rowsBetween(-CONTEXT, 0)
    flagged = moved.join(keys, ["company_id", DAY], "left").withColumn("concerned", F.max("is_new").over(reach))
    fresh = materialize(flagged.where("concerned = 1").select(*moved.columns))

    _write_days(merged, f"{folder}/{STAGED}")
    old = _read(spark, folder, VELOCITY, fresh)
    again = fresh.select(DAY).distinct()
    kept = old.join(F.broadcast(again), DAY, "left_semi").select(*old.columns)
    _write_days(materialize(_replaced(kept, fresh)), f"{folder}/{VELOCITY}")
    written = days.withColumn("model", F.lit(STAGED)).unionByName(again.withColumn("model", F.lit(VELOCITY)))
    return materialize(written.select("model", DAY))
