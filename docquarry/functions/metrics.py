"""Metric aggregations: every function returns an aggregate ``Column``.

Pass a column, a column name or any expression (the place of a script).  Array
fields contribute every element; ``missing`` stands in for absent values.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: str | Column, missing: Any = None) -> Column:
    col = F.col(value) if isinstance(value, str) else value
    return col if missing is None else F.coalesce(col, F.lit(missing))


def _values(value: str | Column, missing: Any) -> Column:
    """The values of a multi-valued field; a document without any has ``missing``."""
    found = F.array_compact(F.col(value) if isinstance(value, str) else value)
    if missing is None:
        return found
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(missing)))


def _sum_of(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda s, x: s + x)


def avg(value: str | Column, missing: Any = None, many: bool = False) -> Column:
    if many:
        found = _values(value, missing)
        return F.try_divide(F.sum(_sum_of(found)), F.sum(F.size(found)))
    return F.avg(_column(value, missing))


def sum(value: str | Column, missing: Any = None, many: bool = False) -> Column:
    return F.sum(_sum_of(_values(value, missing)) if many else _column(value, missing))


def min(value: str | Column, missing: Any = None, many: bool = False) -> Column:
    return F.min(F.array_min(_values(value, missing)) if many else _column(value, missing))


def max(value: str | Column, missing: Any = None, many: bool = False) -> Column:
    return F.max(F.array_max(_values(value, missing)) if many else _column(value, missing))


def value_count(value: str | Column, missing: Any = None, many: bool = False) -> Column:
    """Number of values, not of documents."""
    if many:
        return F.coalesce(F.sum(F.size(_values(value, missing))), F.lit(0)).cast("long")
    return F.count(_column(value, missing))


def stats(value: str | Column, missing: Any = None) -> Column:
    """``struct(count, min, max, avg, sum)``."""
    col = _column(value, missing)
    return F.struct(F.count(col).alias("count"), F.min(col).alias("min"), F.max(col).alias("max"),
                    F.avg(col).alias("avg"), F.sum(col).alias("sum"))


def extended_stats(value: str | Column, missing: Any = None, sigma: float = 2.0) -> Column:
    """:func:`stats` plus squares, population variance and deviation bounds."""
    col = _column(value, missing).cast("double")
    mean, deviation = F.avg(col), F.stddev_pop(col)
    return F.struct(
        F.count(col).alias("count"), F.min(col).alias("min"), F.max(col).alias("max"),
        mean.alias("avg"), F.sum(col).alias("sum"), F.sum(col * col).alias("sum_of_squares"),
        F.var_pop(col).alias("variance"), deviation.alias("std_deviation"),
        F.struct((mean + sigma * deviation).alias("upper"),
                 (mean - sigma * deviation).alias("lower")).alias("std_deviation_bounds"))


def multi(**metrics: Column) -> Column:
    """Several metrics under one name: ``multi(avg=avg("age"), max=max("age"))``."""
    return F.struct(*[m.alias(n) for n, m in metrics.items()])
