"""Bucket aggregations, alone or nested, as flat DataFrames.

One row per bucket (per bucket path when nested).  For a level named ``n`` the
columns are ``n`` (its key), ``n_doc_count`` and the level's metrics.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.functions.fields import FieldRef, FieldScope
from docquarry.functions.intervals import Interval
from docquarry.functions.predicates import all_of
from docquarry.functions.values import literal
from docquarry.session import written


@dataclass(frozen=True)
class Terms:
    """Buckets by value.

    ``order`` maps ``_count``, ``_key``, a metric or its member (``price.avg``) to asc/desc.
    """

    field: str
    size: int = 10
    order: Mapping[str, str] | None = None
    min_doc_count: int = 1
    include: str | Sequence[Any] | None = None
    exclude: str | Sequence[Any] | None = None
    missing: Any = None


@dataclass(frozen=True)
class DateHistogram:
    """Buckets by time interval; gaps are filled when ``min_doc_count`` is 0."""

    field: str
    calendar_interval: str | None = None
    fixed_interval: str | None = None
    format: str | None = None
    time_zone: str | None = None
    offset: str | None = None
    min_doc_count: int = 0
    missing: Any = None

    @property
    def interval(self) -> Interval:
        return Interval.of(self.calendar_interval, self.fixed_interval, self.offset,
                           self.time_zone)


@dataclass(frozen=True)
class Ranges:
    """Buckets by bounds: ``from`` inclusive, ``to`` exclusive, overlaps allowed."""

    field: str
    ranges: Sequence[Mapping[str, Any]]

    def keys(self) -> list[str]:
        return [r.get("key") or f"{r.get('from', '*')}-{r.get('to', '*')}" for r in self.ranges]


Bucket = Terms | DateHistogram | Ranges

# Name of the level of a single bucket aggregation.
_ONLY = "key"


@dataclass(frozen=True)
class Level:
    """A named bucket level with metrics for its rows."""

    name: str
    bucket: Bucket
    metrics: Mapping[str, Column] = field(default_factory=dict)

    @property
    def count(self) -> str:
        return "doc_count" if self.name == _ONLY else f"{self.name}_doc_count"


@dataclass(frozen=True)
class _Slot:
    """A level with the column names it uses while it is computed."""

    level: Level
    depth: int

    @property
    def bucket(self) -> Bucket:
        return self.level.bucket

    @property
    def key(self) -> str:
        return f"__key{self.depth}"

    @property
    def count(self) -> str:
        return f"__count{self.depth}"

    @property
    def measures(self) -> dict[str, str]:
        return {n: f"__metric{self.depth}_{i}" for i, n in enumerate(self.level.metrics)}

    @property
    def columns(self) -> list[str]:
        return [self.key, self.count, *self.measures.values()]

    def blank_unless(self, keep: Column) -> dict[str, Column]:
        """Clear count and metrics where ``keep`` does not hold."""
        return {c: F.when(keep, F.col(c)) for c in (self.count, *self.measures.values())}


def metrics(df: DataFrame, measures: Mapping[str, Column], where: Column | None = None) -> DataFrame:
    """Sibling metrics over all matching rows, in one aggregation."""
    return _matching(df, where).agg(*[m.alias(n) for n, m in measures.items()])


def terms(df: DataFrame, field: str, *, where: Column | None = None,
          sub: Mapping[str, Column] | None = None, **options: Any) -> DataFrame:
    """A single terms level with columns ``key``, ``doc_count`` and sub-metrics."""
    return _single(df, Terms(field, **options), where, sub)


def date_histogram(df: DataFrame, field: str, *, where: Column | None = None,
                   sub: Mapping[str, Column] | None = None, **options: Any) -> DataFrame:
    """A single date histogram with ``key``, ``key_as_string`` and ``doc_count``."""
    return _single(df, DateHistogram(field, **options), where, sub)


def range_buckets(df: DataFrame, field: str, ranges: Sequence[Mapping[str, Any]], *,
                  where: Column | None = None,
                  sub: Mapping[str, Column] | None = None) -> DataFrame:
    """A single range level; every range has a row, empty ones count 0."""
    bucket = Ranges(field, ranges)
    if not sub and not FieldScope(df).field(field).many:
        return _range_counts(_matching(df, where), bucket)
    return _single(df, bucket, where, sub)


def _single(df: DataFrame, bucket: Bucket, where: Column | None,
            sub: Mapping[str, Column] | None) -> DataFrame:
    return nest(df, [Level(_ONLY, bucket, sub or {})], where)


def aggregations(df: DataFrame, *, where: Column | None = None,
                 measures: Mapping[str, Column] | None = None,
                 buckets: Mapping[str, Sequence[Level]] | None = None,
                 persist: bool = False, one_pass: bool = False) -> dict[str, DataFrame]:
    """Several named aggregations over the same matches.

    Metrics share one pass under the name ``metrics``; each bucket tree is its
    own aggregation.  ``persist`` keeps the matches for the passes that follow,
    spilling to disk; the caller unpersists ``matches``.  ``one_pass`` aggregates everything at
    once, see :func:`nest`.
    """
    rows = _matching(df, where)
    out: dict[str, DataFrame] = {}
    if one_pass:
        trees = dict(buckets or {})
        if "metrics" in trees and measures:
            raise ValueError("aggregation 'metrics' is named twice")
        totals, grouped = _one_pass(rows, df, trees, measures or {})
        if measures:
            out["metrics"] = totals
        return out | {name: _nested(df, levels, where, grouped[name]) for name, levels in trees.items()}
    if persist:
        rows = out["matches"] = rows.persist(StorageLevel.MEMORY_AND_DISK)
    if measures:
        out["metrics"] = metrics(rows, measures)
    for name, levels in (buckets or {}).items():
        if name in out:
            raise ValueError(f"aggregation {name!r} is named twice")
        out[name] = nest(rows, levels)
    return out


def nest(df: DataFrame, levels: Sequence[Level], where: Column | None = None, *,
         one_pass: bool = False) -> DataFrame:
    """Bucket levels inside each other, outermost first.

    Each level is one hash aggregation over just the columns it needs, so counts
    of an outer level are exact whatever the inner one does.  A level is joined to
    those outside it after both are aggregated: what meets is buckets, not documents,
    and Spark picks the join by their measured size.

    Every level reads the rows anew.  ``one_pass`` reads them once: each row is repeated for
    every level, all levels are grouped together, and their buckets are written to the shared
    folder at once.  Levels that put a row into several buckets are refused.
    """
    if one_pass:
        _, grouped = _one_pass(_matching(df, where), df, {_ONLY: levels}, {})
        return _nested(df, levels, where, grouped[_ONLY])
    _check_names(levels)
    rows, grouped = _matching(df, where), []
    for slot in _slots(levels):
        parents = _parents(slot)
        rows = _with_key(rows, slot, df, parents)
        grouped.append(rows.groupBy(*parents, slot.key).agg(
            F.count(F.lit(1)).alias(slot.count),
            *[slot.level.metrics[n].alias(m) for n, m in slot.measures.items()]))
        rows = rows.where(F.col(slot.key).isNotNull())
    return _nested(df, levels, where, grouped)


def _slots(levels: Sequence[Level]) -> list[_Slot]:
    return [_Slot(level, depth) for depth, level in enumerate(levels)]


def _parents(slot: _Slot) -> list[str]:
    return [f"__key{depth}" for depth in range(slot.depth)]


def _nested(df: DataFrame, levels: Sequence[Level], where: Column | None, grouped: Sequence[DataFrame]) -> DataFrame:
    """Buckets of all levels, aggregated, as one row a path."""
    slots, result = _slots(levels), None
    for slot, buckets in zip(slots, grouped):
        parents = _parents(slot)
        if result is None:
            result = _shape_outermost(buckets, slot, df, where)
        elif isinstance(slot.bucket, Ranges):
            result = _shape(result.join(buckets, parents, "left"), slot, parents)
        else:
            result = result.join(_shape(buckets, slot, parents), parents, "left")
    return _label(result, slots, FieldScope(df))


def _one_pass(rows: DataFrame, df: DataFrame, trees: Mapping[str, Sequence[Level]],
              measures: Mapping[str, Column]) -> tuple[DataFrame | None, dict[str, list[DataFrame]]]:
    """Totals, and the buckets of every level of every tree, from one aggregation.

    A grouping set a level: a row goes to the sets where all outer keys are present, with the
    keys of deeper levels left out.
    """
    keys, sets = {}, []  # key columns; set: its keys, condition, aggregates by name
    for t, levels in enumerate(trees.values()):
        _check_names(levels)
        for slot in _slots(levels):
            name = f"__{t}_{slot.key}"
            keys[name] = _single_key(slot, df)
            own = [f"__{t}_{p}" for p in [*_parents(slot), slot.key]]
            outer = [F.col(k).isNotNull() for k in (own[:-1] or own)]
            sets.append((own, all_of(outer), {f"__{t}_{m}": slot.level.metrics[n] for n, m in slot.measures.items()}))
    if measures:
        sets.append(([], F.lit(True), {f"__total_{i}": c for i, c in enumerate(measures.values())}))
    rows = rows.withColumns(keys)
    kinds = {k: rows.schema[k].dataType for k in keys}
    entries = [F.when(alive, F.struct(F.lit(i).alias("__set"), *[
        (F.col(k) if k in own else F.lit(None).cast(kinds[k])).alias(k) for k in keys])) for i, (own, alive, _) in enumerate(sets)]
    spread = rows.withColumn("__entry", F.explode(F.array_compact(F.array(*entries))))
    spread = spread.withColumns({k: F.col(f"__entry.{k}") for k in keys}).withColumn("__set", F.col("__entry.__set"))
    found = [c.alias(n) for _, _, aggregates in sets for n, c in aggregates.items()]
    done = written(spread.groupBy("__set", *keys).agg(F.count(F.lit(1)).alias("__count"), *found), "buckets")
    grouped: dict[str, list[DataFrame]] = {}
    number = 0
    for t, (name, levels) in enumerate(trees.items()):
        grouped[name] = []
        for slot in _slots(levels):
            grouped[name].append(done.where(F.col("__set") == number).select(
                *[F.col(f"__{t}_{k}").alias(k) for k in [*_parents(slot), slot.key]], F.col("__count").alias(slot.count),
                *[F.col(f"__{t}_{m}").alias(m) for m in slot.measures.values()]))
            number += 1
    totals = None
    if measures:
        # Without rows there is no group, yet there are totals.
        none = rows.limit(0).agg(*[c.alias(f"__total_{i}") for i, c in enumerate(measures.values())])
        one = done.where(F.col("__set") == number).select([f"__total_{i}" for i in range(len(measures))])
        totals = one.withColumn("__first", F.lit(0)).unionByName(none.withColumn("__first", F.lit(1))).orderBy(
            "__first").limit(1).select(*[F.col(f"__total_{i}").alias(n) for i, n in enumerate(measures)])
    return totals, grouped


def _single_key(slot: _Slot, df: DataFrame) -> Column:
    """Bucket key of a row that is in one bucket at most."""
    bucket, ref = slot.bucket, FieldScope(df).field(slot.bucket.field)
    several = ref.many or ref.analyzer is not None or (isinstance(bucket, Ranges) and not _disjoint(bucket.ranges))
    if several:
        raise ValueError(f"level {slot.level.name!r} puts a row into several buckets: it takes a pass of its own")
    if isinstance(bucket, Ranges):
        return _range_key(ref, bucket, None)
    key = _present(ref, bucket)
    if isinstance(bucket, DateHistogram):
        return bucket.interval.start(key)
    listed = _listed_keys(key, bucket)
    return F.when(all_of(listed), key) if listed else key


def _matching(df: DataFrame, where: Column | None) -> DataFrame:
    return df if where is None else df.where(where)


def _check_names(levels: Sequence[Level]) -> None:
    names = [n for lv in levels for n in (lv.name, lv.count, *lv.metrics)]
    twice = {n for n in names if names.count(n) > 1}
    if twice or not levels:
        raise ValueError(f"aggregation names must be given once each: {sorted(twice)}")


# -- keys -------------------------------------------------------------------
def _with_key(rows: DataFrame, slot: _Slot, df: DataFrame, parents: list[str]) -> DataFrame:
    """Add the bucket key; a row in several buckets is repeated once per bucket.

    Inside another level a row without a bucket stays with a null key, which
    keeps the outer bucket alive if nothing falls into the inner one.
    """
    bucket, ref = slot.bucket, FieldScope(df).field(slot.bucket.field)
    spread = F.explode if slot.depth == 0 else F.explode_outer
    if isinstance(bucket, Ranges):
        rows = rows.withColumn(slot.key, _range_key(ref, bucket, spread))
    elif ref.analyzer is not None:
        rows = rows.withColumn(slot.key, spread(F.array_distinct(ref.tokens())))
    else:
        value = _present(ref, bucket)
        if isinstance(bucket, DateHistogram):
            start = bucket.interval.start
            value = F.transform(value, start) if ref.many else start(value)
        rows = rows.withColumn(slot.key, spread(F.array_distinct(value)) if ref.many else value)
    key = F.col(slot.key)
    listed = _listed_keys(key, bucket)
    if slot.depth == 0:
        return rows.where(all_of([key.isNotNull(), *listed]))
    owned = [F.col(p).isNotNull() for p in parents]
    return rows.withColumn(slot.key, F.when(all_of([*owned, *listed]), key))


def _present(ref: FieldRef, bucket: Bucket) -> Column:
    if bucket.missing is None:
        return ref.column
    stand_in = literal(bucket.missing, ref.dtype).cast(ref.dtype)
    if ref.many:
        kept = F.array_compact(ref.column)
        return F.when(F.size(kept) > 0, kept).otherwise(F.array(stand_in))
    return F.coalesce(ref.column, stand_in)


def _listed_keys(key: Column, bucket: Bucket) -> list[Column]:
    if not isinstance(bucket, Terms):
        return []
    parts = [_listed(key, bucket.include)] if bucket.include is not None else []
    return parts + ([~_listed(key, bucket.exclude)] if bucket.exclude is not None else [])


def _listed(key: Column, rule: str | Sequence[Any]) -> Column:
    if isinstance(rule, str):
        return key.cast("string").rlike(rf"(?s)\A(?:{rule})\z")
    return key.isin(list(rule))


def _range_key(ref: FieldRef, bucket: Ranges, spread: Any) -> Column:
    """Number of the range a row is in; overlapping ranges spread it over several."""
    tests = _range_tests(ref, bucket)
    if not ref.many and _disjoint(bucket.ranges):
        return F.coalesce(*[F.when(test, F.lit(i)) for i, test in enumerate(tests)])
    marks = F.array(*[F.when(test, F.lit(i)).otherwise(F.lit(-1)) for i, test in enumerate(tests)])
    return spread(F.array_remove(marks, -1))


def _disjoint(ranges: Sequence[Mapping[str, Any]]) -> bool:
    try:
        spans = sorted((float(r["from"]) if r.get("from") is not None else -math.inf,
                        float(r["to"]) if r.get("to") is not None else math.inf) for r in ranges)
    except (TypeError, ValueError):
        return False  # bounds that are not plain numbers
    return all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def _range_tests(ref: FieldRef, bucket: Ranges) -> list[Column]:
    def inside(r: Mapping[str, Any]) -> Any:
        def test(c: Column) -> Column:
            parts = [c.isNotNull()]
            if r.get("from") is not None:
                parts.append(c >= literal(r["from"], ref.dtype))
            if r.get("to") is not None:
                parts.append(c < literal(r["to"], ref.dtype))
            return all_of(parts)
        return test
    return [ref.any_value(inside(r)) for r in bucket.ranges]


# -- shaping one level ------------------------------------------------------
def _shape_outermost(grouped: DataFrame, slot: _Slot, df: DataFrame,
                     where: Column | None) -> DataFrame:
    bucket = slot.bucket
    if isinstance(bucket, DateHistogram):
        return _shape(grouped, slot, [])
    if isinstance(bucket, Ranges):
        grid = df.sparkSession.range(1).select(F.explode(F.array(*[
            F.lit(i) for i in range(len(bucket.ranges))])).alias(slot.key))
        return grid.join(grouped, slot.key, "left").fillna(0, [slot.count])
    if bucket.min_doc_count == 0 and where is not None:
        # Values of documents outside the matches come back with a count of 0.
        vocabulary = _with_key(df, slot, df, []).select(slot.key).distinct()
        grouped = vocabulary.join(grouped, slot.key, "left").fillna(0, [slot.count])
    else:
        grouped = grouped.where(F.col(slot.count) >= bucket.min_doc_count)
    return grouped.orderBy(*_terms_order(slot)).limit(bucket.size)


def _shape(grouped: DataFrame, slot: _Slot, parents: list[str]) -> DataFrame:
    """Select and complete the buckets of a level inside each parent."""
    if isinstance(slot.bucket, Terms):
        return _top_terms(grouped, slot, parents)
    if isinstance(slot.bucket, DateHistogram):
        return _fill_dates(grouped, slot, parents)
    return _fill_ranges(grouped, slot, parents)


def _top_terms(grouped: DataFrame, slot: _Slot, parents: list[str]) -> DataFrame:
    key, place = F.col(slot.key), F.col("__place")
    alive = key.isNotNull() & (F.col(slot.count) >= slot.bucket.min_doc_count)
    inside = Window.partitionBy(*parents).orderBy(alive.desc(), *_terms_order(slot))
    # Row-number limits are applied inside the map tasks before the shuffle.
    return (grouped.withColumn("__place", F.row_number().over(inside))
            .where((place <= slot.bucket.size) & (alive | (place == 1)))
            .drop("__place")
            .withColumns({slot.key: F.when(alive, key), **slot.blank_unless(alive)}))


def _terms_order(slot: _Slot) -> list[Column]:
    spec = slot.bucket.order or {"_count": "desc"}
    columns = {"_count": slot.count, "_key": slot.key, **slot.measures}
    out = []
    for name, way in spec.items():
        head, _, member = name.partition(".")
        col = F.col(columns[head])
        col = col.getField(member) if member else col
        out.append(col.desc_nulls_last() if way == "desc" else col.asc_nulls_last())
    return out if "_key" in spec else [*out, F.col(slot.key).asc_nulls_last()]


# Longest array used to write out empty buckets; longer gaps use several.
_GAP_STEP = 10_000


_NEXT = "__following"
# Seconds of time whose buckets are put in order together.
_BLOCK = 7 * 86_400


def _followed(grouped: DataFrame, key: Column) -> tuple[DataFrame, Column]:
    """Buckets with the key of the next one, at any number of buckets.

    The next bucket is looked up inside a week.  The last bucket of a week is followed by
    the first of a later one: one row a week, whatever the interval.
    """
    rows = grouped.withColumn("__block", F.floor(F.unix_timestamp(key.cast("timestamp")) / _BLOCK))
    inside, weeks = Window.partitionBy("__block").orderBy(key), Window.orderBy("__block")
    firsts = rows.groupBy("__block").agg(F.min(key).alias("__first")).select(
        "__block", F.lead("__first").over(weeks).alias("__later"))
    rows = rows.withColumn(_NEXT, F.lead(key).over(inside)).join(firsts, "__block")
    return (rows.withColumn(_NEXT, F.coalesce(_NEXT, "__later")).drop("__block", "__later"),
            F.col(_NEXT))


def _fill_dates(grouped: DataFrame, slot: _Slot, parents: list[str]) -> DataFrame:
    """Each bucket also writes the empty buckets up to the next one.

    The window runs over buckets, not documents, and nothing is joined.
    """
    bucket, key = slot.bucket, F.col(slot.key)
    inside = Window.partitionBy(*parents).orderBy(key.asc_nulls_last())
    upcoming = F.lead(key).over(inside)
    if bucket.min_doc_count == 0 and not parents:
        grouped, upcoming = _followed(grouped, key)
    if bucket.min_doc_count > 0:
        alive = key.isNotNull() & (F.col(slot.count) >= bucket.min_doc_count)
        if not parents:
            return grouped.where(alive)
        first = F.row_number().over(inside.orderBy(alive.desc(), key.asc_nulls_last()))
        return (grouped.withColumn("__place", first).where(alive | (F.col("__place") == 1))
                .drop("__place")
                .withColumns({slot.key: F.when(alive, key), **slot.blank_unless(alive)}))
    n, chunk, last = F.col("__n"), F.col("__chunk"), F.col("__last")
    # Buckets from this one up to the next, less one.
    following = bucket.interval.steps(key, upcoming) - 1
    columns = [c for c in grouped.columns if c != _NEXT]
    rows = grouped.withColumns({
        "__last": F.coalesce(following, F.lit(0)).cast("long"),
        **({"__place": F.row_number().over(inside)} if parents else {})})
    if parents:
        rows = rows.where(key.isNotNull() | (F.col("__place") == 1))
    rows = rows.withColumn("__chunk", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor(last / _GAP_STEP))))
    rows = rows.withColumn("__n", F.explode(F.sequence(
        chunk * _GAP_STEP, F.least(chunk * _GAP_STEP + (_GAP_STEP - 1), last))))
    own = n == 0
    count = F.when(key.isNotNull(), F.when(own, F.col(slot.count)).otherwise(F.lit(0)))
    changed = {slot.key: F.when(own, key).otherwise(bucket.interval.nth(key, n)),
               **slot.blank_unless(own), slot.count: count}
    return rows.select(*[changed[c].alias(c) if c in changed else c for c in columns])


def _fill_ranges(grouped: DataFrame, slot: _Slot, parents: list[str]) -> DataFrame:
    """Each present range also writes the empty ones around it."""
    key, last = F.col(slot.key), len(slot.bucket.ranges) - 1
    inside = Window.partitionBy(*parents).orderBy(key.asc_nulls_last())
    rows = grouped.withColumns({"__prev": F.lag(key).over(inside),
                                "__next": F.lead(key).over(inside),
                                "__place": F.row_number().over(inside)})
    rows = rows.where(key.isNotNull() | (F.col("__place") == 1))
    end = F.when(F.col("__next").isNull(), F.lit(last)).otherwise(key)
    owned = all_of([F.col(p).isNotNull() for p in parents])
    rows = rows.withColumn("__n", F.explode_outer(F.when(owned, F.sequence(
        F.coalesce(F.col("__prev") + 1, F.lit(0)), end))))
    own = F.col("__n").eqNullSafe(key)
    return rows.withColumns({**slot.blank_unless(own), slot.key: F.col("__n"),
                             slot.count: F.when(owned, F.when(own, F.col(slot.count)).otherwise(0))}).drop(
        "__prev", "__next", "__place", "__n")


def _range_counts(rows: DataFrame, bucket: Ranges) -> DataFrame:
    """Counts of all ranges in one pass, one row per range."""
    tests = _range_tests(FieldScope(rows).field(bucket.field), bucket)
    counts = rows.agg(*[F.count_if(t).alias(f"c{i}") for i, t in enumerate(tests)])
    ends = _ends(bucket, FieldScope(rows).field(bucket.field).dtype)
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("key"), low.alias("from"), high.alias("to"), F.col(f"c{i}").alias("doc_count"))
        for i, (k, (low, high)) in enumerate(zip(bucket.keys(), ends))])).alias("r")).select("r.*")


def _ends(bucket: Ranges, dtype: T.DataType) -> list[tuple[Column, Column]]:
    """Both bounds of each range: numbers as doubles, others in the field's own type."""
    given = [r[side] for r in bucket.ranges for side in ("from", "to") if r.get(side) is not None]
    kind = T.DoubleType() if all(isinstance(v, (int, float)) for v in given) else dtype

    def end(value: Any) -> Column:
        return (F.lit(None) if value is None else literal(value, kind)).cast(kind)
    return [(end(r.get("from")), end(r.get("to"))) for r in bucket.ranges]


def _label(result: DataFrame, slots: Sequence[_Slot], scope: FieldScope) -> DataFrame:
    """Final column names, and what a key stands for."""
    out: list[Column] = []
    for slot in slots:
        level, bucket, key = slot.level, slot.bucket, F.col(slot.key)
        if isinstance(bucket, Ranges):
            out.append(F.get(F.array(*map(F.lit, bucket.keys())), key)
                       .alias(level.name))
            ends = _ends(bucket, scope.field(bucket.field).dtype)
            for place, side in enumerate(("from", "to")):
                name = side if level.name == _ONLY else f"{level.name}_{side}"
                out.append(F.get(F.array(*[e[place] for e in ends]), key).alias(name))
        else:
            out.append(key.alias(level.name))
        if isinstance(bucket, DateHistogram) and bucket.format:
            out.append(bucket.interval.label(key, bucket.format).alias(f"{level.name}_as_string"))
        out.append(F.col(slot.count).alias(level.count))
        out += [F.col(m).alias(n) for n, m in slot.measures.items()]
    return result.select(*out)
