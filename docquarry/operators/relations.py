"""Parent/child predicates and table-held value lists, as semi joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has_child(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str,
              where: Column | None = None, negate: bool = False) -> DataFrame:
    """Parents with at least one child that satisfies ``where``.

    Children are reduced to distinct keys first.  Every map task sends a key at
    most once, so a parent that owns most of the children costs one row per task,
    and the join reuses that partitioning.
    """
    keys = _matching_keys(child, where, child_key).distinct()
    return _semi(parent, keys, parent_key, negate)


def has_parent(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str,
               where: Column | None = None, negate: bool = False) -> DataFrame:
    """Children whose parent satisfies ``where``.

    Children are the streamed side and are never grouped.  If the parents do not
    fit a broadcast, adaptive execution splits a partition that one parent's
    children fill (left semi and anti joins allow splitting their left side).
    """
    return _semi(child, _matching_keys(parent, where, parent_key), child_key, negate)


def terms_lookup(df: DataFrame, field: str, values: DataFrame, value_column: str,
                 negate: bool = False) -> DataFrame:
    """Rows whose scalar ``field`` is listed in another table."""
    keys = _matching_keys(values, None, value_column).distinct()
    return _semi(df, keys, field, negate)


def relation_side(df: DataFrame, relation_field: str, name: str) -> DataFrame:
    """Documents of one side of a parent/child pair kept in a single collection."""
    return df.where(F.col(relation_field) == name)


def _matching_keys(df: DataFrame, where: Column | None, key: str) -> DataFrame:
    rows = df if where is None else df.where(where)
    return rows.select(F.col(key).alias("__key"))


def _semi(df: DataFrame, keys: DataFrame, key: str, negate: bool) -> DataFrame:
    # __key is not null on the listed side, so an anti join keeps rows without a key.
    keys = keys.where(F.col("__key").isNotNull())
    return df.join(keys, F.col(key) == F.col("__key"), "left_anti" if negate else "left_semi")
