"""Running totals and exact quantiles over a global order, without one big task.

A window with no partition key sends every row to one task. Here the ordered
values are first reduced to distinct values, cut into ranges of bounded size,
summed per range, and each range adds the offset of the ranges before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize

RANGE_ROWS = 200_000


def _range_edges(df: DataFrame, column: str, rows: int, range_rows: int) -> list[float]:
    """Interior cut points; a short list whatever the size of ``df``."""
    ranges = -(-rows // range_rows)
    if ranges <= 1:
        return []
    probabilities = [i / ranges for i in range(1, ranges)]
    edges = df.approxQuantile(column, probabilities, 1.0 / (4 * ranges))
    return sorted(set(edges))


def with_ranges(df: DataFrame, column: str, edges: Sequence[float]) -> DataFrame:
    """Add ``range_id``, ascending in ``column``; equal values share a range."""
    if not edges:
        return df.withColumn("range_id", F.lit(0))
    splits = [float("-inf"), *edges, float("inf")]
    cut = Bucketizer(splits=splits, inputCol=column, outputCol="range_id", handleInvalid="error")
    return cut.transform(df).withColumn("range_id", F.col("range_id").cast("int"))


def running_totals(
    df: DataFrame,
    order: str,
    sums: Sequence[str],
    groups: Sequence[str] = (),
    descending: bool = False,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Add ``cum_<c>`` for each ``c`` in ``sums``: its total up to this row.

    ``df`` must hold one row per value of ``order`` (and ``groups``); ``order``
    is a double. ``groups`` is meant for a handful of values such as a flag.
    Rows whose ``order`` is NULL or NaN have no place and are left out, whatever the size.
    """
    df = materialize(df.where(F.col(order).isNotNull() & ~F.isnan(F.col(order).cast("double"))))
    edges = _range_edges(df, order, df.count(), range_rows)
    ranged = with_ranges(df, order, edges)

    def ordered(column: str) -> Column:
        return F.col(column).desc() if descending else F.col(column).asc()

    keys = [*groups, "range_id"]
    inside = Window.partitionBy(*keys).orderBy(ordered(order)).rowsBetween(Window.unboundedPreceding, 0)
    if not edges:
        out = ranged.withColumns({f"cum_{c}": F.sum(c).over(inside) for c in sums})
        return out.drop("range_id")

    # One row per range and group.
    totals = ranged.groupBy(*keys).agg(*[F.sum(c).alias(f"part_{c}") for c in sums])
    before = (
        Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    ).orderBy(ordered("range_id")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, *[F.coalesce(F.sum(f"part_{c}").over(before), F.lit(0)).alias(f"offset_{c}") for c in sums]
    )
    # Small by construction: one row per range and group.
    named = offsets.withColumnsRenamed({k: f"of_{k}" for k in keys})
    same = [ranged[k].eqNullSafe(named[f"of_{k}"]) for k in keys]
    joined = ranged.join(F.broadcast(named), same)
    out = joined.withColumns({f"cum_{c}": F.sum(c).over(inside) + F.col(f"offset_{c}") for c in sums})
    return out.drop("range_id", *named.columns)


def global_ranks(rows: DataFrame, order: Sequence[str], parts: int, name: str = "place") -> DataFrame:
    """Add ``name``, the 1-based position in the total order of ``order``.

    Rows are cut into ranges once and stored, so ranges and offsets agree.
    """
    cut = rows.repartitionByRange(parts, *order).withColumn("range_id", F.spark_partition_id())
    placed = materialize(cut)
    sizes = placed.groupBy("range_id").agg(F.count(F.lit(1)).alias("n"))
    # One row per range.
    before = Window.partitionBy(F.lit(0)).orderBy("range_id").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("range_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("range_id").orderBy(*order)
    return (
        placed.join(F.broadcast(offsets), "range_id")
        .withColumn(name, F.row_number().over(inside) + F.col("offset"))
        .drop("range_id", "offset")
    )


def hash_ranks(
    df: DataFrame,
    key: str,
    seed: int,
    groups: Sequence[str],
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Add ``hash_rank`` (1-based, by seeded hash of ``key``) and ``group_rows``.

    The hash is uniform, so its top part cuts each group, however large, into
    even ranges of about ``range_rows`` rows at most; a rank is the place in its
    range plus the rows before it, so it does not depend on the number of ranges.
    """
    ranges = max(1, -(-df.count() // range_rows))
    hashed = df.withColumn("row_hash", F.xxhash64(F.col(key), F.lit(seed)))
    share = F.pmod(F.shiftrightunsigned("row_hash", 33), F.lit(2**31)).cast("double") / float(2**31)
    ranged = hashed.withColumn("range_id", F.floor(share * ranges).cast("int"))

    keys = [*groups, "range_id"]
    sizes = ranged.groupBy(*keys).agg(F.count(F.lit(1)).alias("range_rows"))
    before = Window.partitionBy(*groups).orderBy("range_id").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    offsets = sizes.select(
        *keys,
        F.coalesce(F.sum("range_rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("range_rows").over(whole).alias("group_rows"),
    )
    inside = Window.partitionBy(*keys).orderBy(
        F.shiftrightunsigned("row_hash", 33), "row_hash", key
    )
    # One row for each range of a group.
    return (
        ranged.join(F.broadcast(offsets), keys)
        .withColumn("hash_rank", F.row_number().over(inside) + F.col("rows_before"))
        .drop("row_hash", "range_id", "rows_before")
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: Sequence[float],
    groups: Sequence[str] = (),
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Linear-interpolated quantiles ``q_<percent>`` per group."""
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*groups, F.col(value).cast("double").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = running_totals(counts, "value", ["n"], groups, range_rows=range_rows)
    sizes = totals.groupBy(*groups).agg(F.sum("n").alias("rows"))
    if groups:
        placed = totals.join(F.broadcast(sizes), list(groups))
    else:
        size = sizes.select("rows").scalar()
        placed = totals.withColumn("rows", size)

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("cum_n") > rank, F.col("value")))

    aggregates = []
    for p in probabilities:
        place = (F.col("rows") - 1).cast("double") * F.lit(float(p))
        low, high = at(F.floor(place)), at(F.ceil(place))
        part = F.max(place - F.floor(place))
        aggregates.append((low + (high - low) * part).alias(f"q_{round(p * 100)}"))
    return placed.groupBy(*groups).agg(*aggregates)
