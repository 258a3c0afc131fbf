"""Numeric column helpers whose results do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def round_to(value: Column | str, digits: int) -> Column:
    """Round a double half away from zero after scaling by ``10**digits``.

    Same bits as an engine that scales, rounds to a whole number and scales
    back, unlike ``F.round`` which rounds the printed decimal form.
    """
    value = as_col(value).cast("double")
    if digits == 0:
        return F.round(value, 0)
    scale = F.lit(float(10**digits))
    return F.round(value * scale, 0) / scale


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Double division, NULL when the denominator is NULL or zero."""
    bottom = as_col(denominator).cast("double")
    return as_col(numerator).cast("double") / F.nullif(bottom, F.lit(0.0))


def exact_avg(value: Column | str, digits: int) -> Column:
    """Average of a double that carries at most ``digits`` decimals.

    The sum is taken over whole numbers, so partial aggregates may merge in any
    order and a retried task gives the same bits.
    """
    value = as_col(value)
    scale = float(10**digits)
    units = F.round(value * F.lit(scale), 0).cast("long")
    total = F.sum(units).cast("double")
    return total / F.nullif(F.count(value).cast("double") * F.lit(scale), F.lit(0.0))


def exact_slope(y: Column, x: Column, use: Column) -> Column:
    """Least-squares slope of whole-number ``y`` on ``x`` over rows where ``use``.

    Integer sums make it order-free; NULL when ``x`` does not vary.
    """
    keep = use & y.isNotNull() & x.isNotNull()
    y, x = y.cast("long"), x.cast("long")
    n = F.count_if(keep)
    sum_x, sum_y = F.sum(F.when(keep, x)), F.sum(F.when(keep, y))
    sum_xy, sum_xx = F.sum(F.when(keep, x * y)), F.sum(F.when(keep, x * x))
    return ratio(n * sum_xy - sum_x * sum_y, n * sum_xx - sum_x * sum_x)


def equal_width_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Zero-based bin of ``value`` in ``bins`` equal parts of [low, high].

    The top edge belongs to the last bin. A single-point range is widened by
    one half on each side.
    """
    flat = high == low
    start = F.when(flat, low - 0.5).otherwise(low).cast("double")
    width = bin_width(low, high, bins)
    raw = F.floor((value.cast("double") - start) / width)
    return F.least(raw, F.lit(bins - 1)).cast("int")


def bin_width(low: Column, high: Column, bins: int) -> Column:
    span = F.when(high == low, F.lit(1.0)).otherwise((high - low).cast("double"))
    return span / F.lit(float(bins))


def bin_start(low: Column, high: Column, bins: int, index: Column) -> Column:
    start = F.when(high == low, low - 0.5).otherwise(low).cast("double")
    return start + index * bin_width(low, high, bins)
