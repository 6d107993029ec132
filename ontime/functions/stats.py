"""Aggregate expressions that stay defined on constant columns under ANSI rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _both(x: Column, y: Column) -> tuple[Column, Column]:
    return F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)


def pearson(x: Column, y: Column) -> Column:
    """Correlation over rows where both are known; null when either one is constant."""
    xs, ys = _both(x, y)
    return F.try_divide(F.covar_pop(x, y), F.sqrt(F.var_pop(xs)) * F.sqrt(F.var_pop(ys)))


def slope(x: Column, y: Column) -> Column:
    """Least-squares slope of y on x; null when x is constant."""
    return F.try_divide(F.covar_pop(x, y), F.var_pop(_both(x, y)[0]))


def intercept(x: Column, y: Column) -> Column:
    xs, ys = _both(x, y)
    return F.avg(ys) - slope(x, y) * F.avg(xs)


def equal_width_bin(x: Column, low: Column, high: Column, bins: int) -> Column:
    """Bin number 0..bins-1; the maximum belongs to the last bin and a constant column to bin 0."""
    place = F.floor(F.try_divide((x - low) * bins, high - low))
    return F.when(x.isNotNull(), F.least(F.coalesce(place, F.lit(0).cast("bigint")), F.lit(bins - 1).cast("bigint")))


def rounded(column: Column, places: int = 6) -> Column:
    return F.round(column, places)
