"""Helpers shared by the operators: checkpoints, tables of a folder, exact ranks in large groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import materialize, scratch_path

__all__ = ["materialize", "scratch_path", "table", "written", "ranked", "hot_join"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again: cuts lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranked(rows: DataFrame, group: str, salt: Column, order: Sequence[str | Column], cells: int, name: str) -> DataFrame:
    """Add ``name``: the 0-based place of a row among those with the same ``group``.

    A group may hold any share of the rows. Each is cut by ``salt`` (a hash) into ``cells``
    parts, every part is ordered on its own, and a part starts after all parts before it.
    Rows equal in ``order`` may swap places.
    """
    cut = rows.withColumn("rank_cell", F.pmod(salt, F.lit(cells)).cast("int"))
    counts = cut.groupBy(group, "rank_cell").agg(F.count(F.lit(1)).alias("rank_n"))
    # At most ``cells`` rows in each window, each the count of one part.
    before = Window.partitionBy(group).orderBy("rank_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group, "rank_cell", F.coalesce(F.sum("rank_n").over(before), F.lit(0)).alias("rank_base"))
    inside = Window.partitionBy(group, "rank_cell").orderBy(*order)
    placed = cut.withColumn(name, F.row_number().over(inside) - 1)
    return (
        placed.join(offsets, [group, "rank_cell"])
        .withColumn(name, (F.col(name) + F.col("rank_base")).cast("long"))
        .drop("rank_cell", "rank_base")
    )


#: A key with more than 1 / HOT_PARTS of all rows is hot; there are fewer than HOT_PARTS of them, so their list is small.
HOT_PARTS = 512
HOT_LEAST = 2_000


def hot_join(rows: DataFrame, one: DataFrame, keys: Sequence[str], spread: Sequence[str | Column], how: str = "left") -> DataFrame:
    """Join many ``rows`` to ``one`` row per key, where a key may hold any share of ``rows``.

    Rows of a hot key are spread over parts by a hash of ``spread``; the row of ``one`` is repeated for
    each part. ``rows`` is read twice, so it should be stored. Null keys match nothing and are spread too.
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("hot_n"))
    total = rows.count()
    limit = max(HOT_LEAST, total // HOT_PARTS)
    hot = materialize(counts.where(F.col("hot_n") > limit).select(*keys, F.ceil(F.col("hot_n") / limit).cast("int").alias("hot_ways")))
    if hot.isEmpty():
        return rows.join(one, list(keys), how)
    same = [rows[k].eqNullSafe(hot[k]) for k in keys]
    ways = F.coalesce("hot_ways", F.lit(1))
    part = F.pmod(F.xxhash64(*spread), ways).cast("int")
    left = rows.join(F.broadcast(hot), same, "left").select(*[rows[c] for c in rows.columns], part.alias("hot_part"))
    parts = F.explode(F.sequence(F.lit(0), ways - 1))
    right = one.join(F.broadcast(hot), list(keys), "left").withColumn("hot_part", parts).drop("hot_ways")
    return left.join(right, [*keys, "hot_part"], how).drop("hot_part")
