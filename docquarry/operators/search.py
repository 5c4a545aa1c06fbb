"""Search over one collection: filter, sort, page, project, count, look up."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from fnmatch import fnmatchcase
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.functions import addresses
from docquarry.functions.fields import FieldScope
from docquarry.functions.predicates import all_of, any_of, holds
from docquarry.session import written

ID = "_id"
#: Pages that start later are found by counting instead of ranking all before them.
DEEP = 10_000


@dataclass(frozen=True)
class SortBy:
    """One sort field; ``missing`` is ``_first``, ``_last`` or a stand-in value."""

    field: str
    order: str = "asc"
    missing: Any = "_last"
    mode: str | None = None

    def value(self, scope: FieldScope) -> Column:
        ref = scope.field(self.field)
        col = ref.column
        if ref.is_address and isinstance(ref.dtype, T.StringType):
            col = F.transform(col, addresses.ordered) if ref.many else addresses.ordered(col)
        if ref.many:
            col = _reduce(col, self.mode or ("min" if self.order == "asc" else "max"), ref.dtype)
        if self.missing not in ("_first", "_last"):
            col = F.coalesce(col, addresses.literal(self.missing) if ref.is_address else F.lit(self.missing))
        return col

    def ordering(self, col: Column) -> Column:
        if self.order not in ("asc", "desc"):
            raise ValueError(f"unknown sort order {self.order!r}")
        first = self.missing == "_first"
        if self.order == "asc":
            return col.asc_nulls_first() if first else col.asc_nulls_last()
        return col.desc_nulls_first() if first else col.desc_nulls_last()

    def beyond(self, col: Column, value: Any) -> Column:
        """Rows that sort strictly after ``value``."""
        first = self.missing == "_first"
        if value is None:
            return col.isNotNull() if first else F.lit(False)
        after = col > F.lit(value) if self.order == "asc" else col < F.lit(value)
        return after if first else after | col.isNull()


def _reduce(array: Column, mode: str, dtype: T.DataType) -> Column:
    """Collapse a multi-valued field to one sort value."""
    values = F.array_compact(array)
    if mode == "min":
        return F.array_min(values)
    if mode == "max":
        return F.array_max(values)
    size = F.size(values)
    total = F.aggregate(values, F.lit(0).cast("double"), lambda s, x: s + x)
    if mode == "sum":
        return F.when(size > 0, total)
    if mode == "avg":
        return F.when(size > 0, total / size)
    if mode == "median":
        ordered = F.array_sort(values)
        low = F.get(ordered, F.floor((size - 1) / 2).cast("int"))
        high = F.get(ordered, F.floor(size / 2).cast("int"))
        return F.when(size > 0, (low + high) / 2)
    raise ValueError(f"unknown sort mode {mode!r}")


def search(df: DataFrame, where: Column | None = None, sort: Sequence[SortBy | str] = (),
           from_: int = 0, size: int = 10, source: Any = True, key: str = ID,
           after: Sequence[Any] | None = None) -> DataFrame:
    """One page of matching documents.

    Ties are broken by ``key``, so pages are stable.  ``after`` holds the sort
    values and key of the last row seen: paging by it costs the same at any
    depth.  A page that starts beyond DEEP is found by counting: see :func:`_start_of`.
    """
    hits = df if where is None else df.where(where)
    rules = [SortBy(s) if isinstance(s, str) else s for s in sort] + [SortBy(key)]
    scope = FieldScope(df)
    names = [f"__sort_{i}" for i in range(len(rules) - 1)] + [key]
    hits = hits.withColumns({n: r.value(scope) for n, r in zip(names[:-1], rules)})
    columns = [F.col(n) for n in names]
    if after is not None:
        hits = hits.where(_after(rules, columns, after))
    if from_ > DEEP:
        start = _start_of(hits, rules, columns, from_)
        if start is None:
            return df.limit(0).select(*_source_columns(df, source, key))
        values, from_ = start
        same = all_of([c.eqNullSafe(F.lit(v)) for c, v in zip(columns, values)])
        hits = hits.where(any_of([same, _after(rules, columns, values)]))
    hits = hits.orderBy(*[r.ordering(c) for r, c in zip(rules, columns)])
    hits = (hits.offset(from_) if from_ else hits).limit(size)
    return hits.select(*_source_columns(df, source, key))


def _start_of(hits: DataFrame, rules: list[SortBy], columns: list[Column], from_: int) -> tuple[list[Any], int] | None:
    """Sort values of the row at place ``from_``, and how many equal ones stand before it.

    Sort values alone are dealt into ranges and counted; only the range that the place falls
    into is sorted.  The page itself is then read from these values on.
    """
    order = [r.ordering(c) for r, c in zip(rules, columns)]
    ranged = written(hits.select(*columns).repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "page")
    for r in sorted(ranged.groupBy("__range").count().collect()):  # a row for each range
        if from_ < r["count"]:
            inside = ranged.where(F.col("__range") == r["__range"]).drop("__range")
            values = list(inside.orderBy(*order).offset(from_).limit(1).first())
            return values, from_ - inside.where(_before(rules, columns, values)).count()
        from_ -= r["count"]
    return None


def _before(rules: list[SortBy], columns: list[Column], values: list[Any]) -> Column:
    """Rows that sort strictly before ``values``."""
    same = all_of([c.eqNullSafe(F.lit(v)) for c, v in zip(columns, values)])
    return ~holds(any_of([same, _after(rules, columns, values)]))


def _after(rules: list[SortBy], columns: list[Column], last: Sequence[Any]) -> Column:
    if len(last) != len(rules):
        raise ValueError("after needs one value per sort field, then the key")
    steps = []
    for i, (rule, col) in enumerate(zip(rules, columns)):
        same = [c.eqNullSafe(F.lit(v)) for c, v in zip(columns[:i], last)]
        steps.append(all_of([*same, rule.beyond(col, last[i])]))
    return any_of(steps)


def source_filter(df: DataFrame, source: Any, key: str = ID) -> DataFrame:
    """Keep part of each document; ``key`` always stays.

    ``source``: ``True`` all, ``False`` the key alone, a list of included paths,
    or ``{"includes": [...], "excludes": [...]}``.  Paths may be dotted and may
    hold ``*``.
    """
    return df.select(*_source_columns(df, source, key))


def _source_columns(df: DataFrame, source: Any, key: str) -> list[Column]:
    if source is True:
        return [F.col(f"`{c}`") for c in df.columns]
    if source is False:
        includes, excludes = [], ["*"]
    elif isinstance(source, Mapping):
        includes = list(source.get("includes") or ["*"])
        excludes = list(source.get("excludes") or [])
    else:
        includes, excludes = [source] if isinstance(source, str) else list(source), []
    out = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        kept = col if field.name == key else _pick(col, field.dataType, field.name,
                                                   includes, excludes)
        if kept is not None:
            out.append(kept.alias(field.name))
    return out


def _covered(path: str, patterns: Iterable[str]) -> bool:
    parts = path.split(".")
    heads = [".".join(parts[:i]) for i in range(1, len(parts) + 1)]
    return any(fnmatchcase(h, p) for h in heads for p in patterns)


def _pick(col: Column, dtype: T.DataType, path: str, includes: list[str],
          excludes: list[str]) -> Column | None:
    if _covered(path, excludes):
        return None
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
        if _whole(dtype.elementType, path, includes, excludes):
            return col
        if _parts(F.lit(None), dtype.elementType, path, includes, excludes) == []:
            return None
        return F.transform(col, lambda e: _rebuild(e, dtype.elementType, path, includes, excludes))
    if isinstance(dtype, T.StructType):
        if _whole(dtype, path, includes, excludes):
            return col
        return _rebuild(col, dtype, path, includes, excludes)
    return col if _covered(path, includes) else None


def _whole(dtype: T.StructType, path: str, includes: list[str], excludes: list[str]) -> bool:
    leaves = list(_leaves(dtype, path))
    return all(_covered(p, includes) and not _covered(p, excludes) for p in leaves)


def _leaves(dtype: T.DataType, path: str) -> Iterable[str]:
    if isinstance(dtype, T.ArrayType):
        dtype = dtype.elementType
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            yield from _leaves(f.dataType, f"{path}.{f.name}")
    else:
        yield path


def _parts(col: Column, dtype: T.StructType, path: str, includes: list[str],
           excludes: list[str]) -> list[str]:
    return [f.name for f in dtype.fields
            if any(_covered(p, includes) and not _covered(p, excludes)
                   for p in _leaves(f.dataType, f"{path}.{f.name}"))]


def _rebuild(col: Column, dtype: T.StructType, path: str, includes: list[str],
             excludes: list[str]) -> Column | None:
    names = _parts(col, dtype, path, includes, excludes)
    if not names:
        return None
    picked = [_pick(col.getField(n), dtype[n].dataType, f"{path}.{n}", includes,
                    excludes).alias(n) for n in names]
    return F.when(col.isNotNull(), F.struct(*picked))


def count(df: DataFrame, where: Column | None = None) -> DataFrame:
    """Number of matching documents, as one row ``count``."""
    hits = df if where is None else df.where(where)
    return hits.agg(F.count(F.lit(1)).alias("count"))


def total_hits(df: DataFrame, where: Column | None = None,
               track: bool | int = True) -> DataFrame:
    """Hit total as ``(value, relation)``; a number ``track`` caps the count.

    ``False`` asks for no total: one row of nulls, and nothing is read.  All others are
    one lazy aggregate that every task pre-aggregates.
    """
    if track is False:
        return df.sparkSession.range(1).select(F.lit(None).cast("long").alias("value"),
                                               F.lit(None).cast("string").alias("relation"))
    hits = df if where is None else df.where(where)
    if track is True:
        return hits.agg(F.count(F.lit(1)).alias("value")).withColumn("relation", F.lit("eq"))
    found = F.count(F.lit(1))
    return hits.agg(F.least(found, F.lit(track)).alias("value"),
                    F.when(found > track, "gte").otherwise("eq").alias("relation"))


def get(df: DataFrame, doc_id: Any, key: str = ID) -> DataFrame:
    """The document with this id, or no row."""
    return df.where(F.col(key) == F.lit(doc_id))


def get_by_ids(df: DataFrame, ids: DataFrame | Iterable[Any], key: str = ID) -> DataFrame:
    """The documents with these ids: a list, or a frame holding a ``key`` column.

    A frame may be of any size.  Spark broadcasts it when its measured size is
    under the session's limit and sort-merge joins otherwise.  Repeats collapse
    inside the map tasks, so an id listed very often costs one row per task.
    """
    if isinstance(ids, DataFrame):
        return df.join(ids.select(key).distinct(), key, "left_semi")
    return df.where(F.col(key).isin(list(ids)))
