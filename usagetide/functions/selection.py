"""Exact quantiles by counting: no sort, no window, no shuffle of rows.

A rank is narrowed down from the whole range of values. Each pass cuts the range that holds it into ``BINS`` equal
parts and counts the rows of each part, with the smallest and largest value there; the part that holds the rank is
the next range. When smallest and largest are one value, the rank has it, however many rows share it. A pass is one
aggregate with map-side combination; it returns at most ``BINS`` rows for each range still open. The smallest and
the largest value of a range never share a part, so every pass narrows; two or three are the rule.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import materialize

BINS = 8192


@dataclass
class _Range:
    """Values ``low`` to ``high`` of a group, with ``below`` rows of the group under ``low``."""

    low: float
    high: float
    below: int


def _part(value: Column, r: _Range) -> Column:
    """Halves first: the width of a range of doubles may be no double."""
    share = (value / 2.0 - F.lit(r.low / 2.0)) / F.lit(r.high / 2.0 - r.low / 2.0)
    return F.least(F.floor(share * F.lit(float(BINS))), F.lit(BINS - 1)).cast("int")


def order_statistics(
    df: DataFrame, value: str, ranks: dict[tuple, Sequence[int]], ranges: dict[tuple, _Range], groups: Sequence[str] = ()
) -> dict[tuple, dict[int, float]]:
    """The values at 0-based ``ranks`` of each group, whose whole range is in ``ranges``."""
    found: dict[tuple, dict[int, float]] = {g: {} for g in ranks}
    open_ranks = {(g, r): ranges[g] for g, wanted in ranks.items() for r in set(wanted)}
    while open_ranks:
        for (g, r), now in list(open_ranks.items()):
            if now.low == now.high:
                found[g][r] = now.low
                del open_ranks[g, r]
        # Ranks of one range share its counts.
        wanted = {(g, now.low, now.high): now for (g, _), now in open_ranks.items()}
        if not wanted:
            break
        place = part = None
        for k, ((g, low, high), now) in enumerate(wanted.items()):
            here = (F.col(value) >= F.lit(low)) & (F.col(value) <= F.lit(high))
            for c, v in zip(groups, g):
                here &= F.col(c).eqNullSafe(F.lit(v))
            place = F.when(here, k) if place is None else place.when(here, k)
            part = F.when(here, _part(F.col(value), now)) if part is None else part.when(here, _part(F.col(value), now))
        counts = (
            df.select(place.alias("place"), part.alias("part"), F.col(value).alias("v")).where("place IS NOT NULL")
            .groupBy("place", "part").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        )
        parts: dict[int, list] = {}
        for row in counts.collect():
            parts.setdefault(row.place, []).append(row)
        at = {key: sorted(parts[k], key=lambda row: row.part) for k, key in enumerate(wanted)}
        for (g, r), now in list(open_ranks.items()):
            below = now.below
            for row in at[g, now.low, now.high]:
                if r < below + row.n:
                    open_ranks[g, r] = _Range(row.low, row.high, below)
                    break
                below += row.n
    return found


def exact_quantiles(
    df: DataFrame, value: str, probabilities: Sequence[float], groups: Sequence[str] = (), stored: bool = False
) -> DataFrame:
    """Linear-interpolated quantiles ``q_<percent>`` per group; NULL and NaN have no rank.

    ``stored`` says that ``df`` is cheap to read again; else its values are stored first.

    ``groups`` is meant for a handful of values such as a flag. Infinite values count as the largest doubles. Without
    groups, an empty table gives one row of NULLs.
    """
    most = 1.7976931348623157e308
    number = F.col(value).cast("double")
    rows = df.where(number.isNotNull() & ~F.isnan(number)).select(
        *groups, F.greatest(F.least(number, F.lit(most)), F.lit(-most)).alias("value")
    )
    rows = rows if stored else materialize(rows)
    sizes = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).collect()
    sizes = {tuple(r)[: len(groups)]: (r.n, r.low, r.high) for r in sizes if r.n}
    places = {g: [(n - 1) * float(p) for p in probabilities] for g, (n, _, _) in sizes.items()}
    ranks = {g: [f(x) for x in at for f in (math.floor, math.ceil)] for g, at in places.items()}
    found = order_statistics(rows, "value", ranks, {g: _Range(low, high, 0) for g, (_, low, high) in sizes.items()}, groups)
    out = []
    for g, at in places.items():
        low_high = [(found[g][math.floor(x)], found[g][math.ceil(x)], x - math.floor(x)) for x in at]
        out.append((*g, *[low + (high - low) * share for low, high, share in low_high]))
    if not out and not groups:
        out.append((None,) * len(probabilities))
    fields = [df.schema[g] for g in groups] + [T.StructField(f"q_{round(p * 100)}", T.DoubleType()) for p in probabilities]
    return df.sparkSession.createDataFrame(out, T.StructType(fields))
