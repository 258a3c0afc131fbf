"""Joins that hold when one key has a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

HOT_ROWS = 1_000_000
HOT_KEYS = 4_096


def hot_keys(rows: DataFrame, key: str, hot_rows: int = HOT_ROWS, most: int = HOT_KEYS) -> DataFrame:
    """Keys with more rows than a part holds, and the number of parts to cut them into.

    A part holds ``hot_rows`` rows, or a share of 1 / ``most`` of all rows where that is more. So fewer
    than ``most`` keys come out whatever the input; counts combine map-side.
    """
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    part = F.greatest(F.lit(hot_rows), F.ceil(counts.agg(F.sum("n")).scalar() / F.lit(most)))
    return counts.where(F.col("n") > part).select(key, F.ceil(F.col("n") / part).cast("int").alias("ways"))


def join_split_hot(
    rows: DataFrame, dimension: DataFrame, key: str, spread_by: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Inner join of many ``rows`` to a ``dimension`` with one row per ``key``.

    Rows of a hot key are spread over several tasks by a hash of ``spread_by``;
    only the dimension rows of hot keys are repeated. The hot list is broadcast:
    it has fewer than ``HOT_KEYS`` rows by construction. One plan for every size.
    """
    hot = F.broadcast(hot_keys(rows, key, hot_rows))
    part = F.coalesce(F.pmod(F.xxhash64(spread_by), F.col("ways")), F.lit(0)).cast("int")
    parts = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("ways"), F.lit(1)) - 1))
    left = rows.join(hot, key, "left").withColumn("hot_part", part).drop("ways")
    right = dimension.join(hot, key, "left").withColumn("hot_part", parts).drop("ways")
    return left.join(right, [key, "hot_part"]).drop("hot_part")
