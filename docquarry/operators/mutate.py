"""Keyed writes as DataFrame transformations.

Every function takes the current rows and returns the new ones, so the result
can be checked, combined or stored as a new snapshot.  A frame that Spark reads
from a path must never be written back to that path; see ``sources.snapshots``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.functions.predicates import holds
from docquarry.operators.search import ID

INDEX, DELETE = "index", "delete"


# -- whole documents -----------------------------------------------------------
def last_per_key(ops: DataFrame, key: str, seq: str) -> DataFrame:
    """The row with the highest ``seq`` of every key; rows without a key are all kept.

    Only key and order are aggregated, by hashing and combined inside the map tasks; the
    documents are then picked by a join on both.  Where several rows of a key share the
    highest order, the greatest of them counts.
    """
    given = ops.where(F.col(key).isNotNull())
    last = (given.groupBy(key, seq).agg(F.count(F.lit(1)).alias("__n")).groupBy(key)
            .agg(F.max(seq).alias("__seq"), F.max_by("__n", seq).alias("__n"))
            .withColumnRenamed(key, "__key"))
    same = (F.col(key) == F.col("__key")) & F.col(seq).eqNullSafe(F.col("__seq"))
    rest = F.struct(*[c for c in ops.columns if c not in (key, seq)])
    # Rows meet partitioned by key and order; only tied ones are compared.
    tied = Window.partitionBy(key, seq).orderBy(F.when(F.col("__n") > 1, rest).desc())
    picked = given.join(last, same).withColumn("__place", F.row_number().over(tied)).where("__place = 1")
    return picked.select(*ops.columns).unionByName(ops.where(F.col(key).isNull()))


def _without(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The documents that no row of ``keys`` names."""
    if key not in keys.columns:
        return target
    named = keys.select(key).where(F.col(key).isNotNull()).distinct()
    return target.join(named, key, "left_anti").select(*target.columns)


def with_ids(df: DataFrame, key: str = ID) -> DataFrame:
    """Give rows without an id a random one."""
    if key not in df.columns:
        return df.withColumn(key, F.expr("uuid()"))
    return df.withColumn(key, F.coalesce(F.col(key), F.expr("uuid()")))


def upsert(target: DataFrame, source: DataFrame, key: str = ID, seq: str | None = None,
           allow_new: bool = False) -> DataFrame:
    """Replace or create whole documents.

    Fields a source row lacks become null.  With ``seq`` the last source row per
    key wins; without it a source that repeats a key fails.  Rows without a key are
    documents of their own, and get an id if ids are strings.  ``allow_new`` lets the
    source add columns.
    """
    # Which documents go is known without the last row of each key.
    kept = _without(target, source, key)
    source = last_per_key(source, key, seq).drop(seq) if seq is not None else _unrepeated(source, key)
    if isinstance(target.schema[key].dataType, T.StringType):
        source = with_ids(source, key)
    extra = [c for c in source.columns if c not in target.columns]
    if extra and not allow_new:
        raise ValueError(f"unknown fields: {extra}")
    return kept.unionByName(_typed_like(source, target), allowMissingColumns=True)


def _unrepeated(source: DataFrame, key: str) -> DataFrame:
    """The rows; reading them fails if a key is there twice."""
    if key not in source.columns:
        return source
    most = (source.where(F.col(key).isNotNull()).groupBy(key).count()
            .agg(F.coalesce(F.max("count"), F.lit(0)).alias("n")).select("n"))
    return source.where(F.assert_true(
        most.scalar() <= 1, "a key is given twice: name the column that orders its rows").isNull())


def _typed_like(source: DataFrame, target: DataFrame) -> DataFrame:
    known = {f.name: f.dataType for f in target.schema.fields}
    return source.select(*[F.col(c).cast(known[c]).alias(c) if c in known else F.col(c)
                           for c in source.columns])


def delete_by_ids(target: DataFrame, ids: DataFrame | Iterable[Any], key: str = ID) -> DataFrame:
    """Rows whose id is not listed: in a list, or in a frame of any size."""
    if isinstance(ids, DataFrame):
        return target.join(ids.select(key).distinct(), key, "left_anti").select(*target.columns)
    return target.where(~holds(F.col(key).isin(list(ids))))


def apply_ops(target: DataFrame, ops: DataFrame, key: str = ID, seq: str = "seq",
              op: str = "op") -> DataFrame:
    """Apply a mixed batch of index and delete operations; the last one per key wins.

    Other operations have no effect; :func:`bulk_report` lists them as errors.  A document
    without a key is a new one, and gets an id if ids are strings.
    """
    ops = ops.where(F.col(op).isin(INDEX, DELETE))
    kept, last = _without(target, ops, key), last_per_key(ops, key, seq)
    added = last.where(F.col(op) == INDEX).drop(op, seq)
    if isinstance(target.schema[key].dataType, T.StringType):
        added = with_ids(added, key)
    return kept.unionByName(_typed_like(added, target), allowMissingColumns=True)


# -- parts of documents ----------------------------------------------------------
def update_by_query(df: DataFrame, where: Column, updates: Mapping[str, Any],
                    key: str = ID) -> DataFrame:
    """Set fields on the rows that match; the key can't be changed.

    A mapping value sets members of an object, a dotted name sets one member, and
    an array field is replaced as a whole.  Values are literals or Columns.
    """
    match, schema = holds(where), df.schema
    columns: dict[str, Column] = {}
    for path, value in updates.items():
        name, _, inner = path.partition(".")
        if name == key:
            raise ValueError(f"the key {key!r} can't be updated")
        if name not in schema.fieldNames():
            raise ValueError(f"unknown field {name!r}")
        dtype = schema[name].dataType
        current = columns.get(name, F.col(f"`{name}`"))
        columns[name] = _assign(current, dtype, _unfold(inner, value) if inner else value)
    return df.withColumns({n: F.when(match, new).otherwise(F.col(f"`{n}`"))
                           for n, new in columns.items()})


def _unfold(path: str, value: Any) -> dict[str, Any]:
    head, _, rest = path.partition(".")
    return {head: _unfold(rest, value) if rest else value}


def _assign(current: Column, dtype: T.DataType, value: Any) -> Column:
    if isinstance(value, Mapping) and isinstance(dtype, T.StructType):
        unknown = set(value) - set(dtype.fieldNames())
        if unknown:
            raise ValueError(f"unknown fields: {sorted(unknown)}")
        return F.struct(*[
            (_assign(current.getField(f.name), f.dataType, value[f.name])
             if f.name in value else current.getField(f.name)).alias(f.name)
            for f in dtype.fields])
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType) \
            and isinstance(value, (list, tuple)):
        items = [F.struct(*[F.lit(item.get(f.name)).cast(f.dataType).alias(f.name)
                            for f in dtype.elementType.fields]) for item in value]
        return F.array(*items).cast(dtype)
    if isinstance(value, (list, tuple)):
        return F.array(*[F.lit(v) for v in value]).cast(dtype)
    return (value if isinstance(value, Column) else F.lit(value)).cast(dtype)


def delete_by_query(df: DataFrame, where: Column) -> DataFrame:
    return df.where(~holds(where))


def merge_fields(target: DataFrame, patch: DataFrame, key: str = ID,
                 seq: str | None = None, nulls: bool = False) -> DataFrame:
    """Merge the fields of ``patch`` into existing rows.

    Objects merge member by member.  With ``seq`` several patches of one key are
    applied in order, without it the greatest value of each field counts; either
    way a row of the target stays one row.  A null leaves a field as it is, or with
    ``nulls`` clears it, as every column of the patch then counts as given.  Ids absent
    from the target are given by :func:`unmatched`.
    """
    fields = [c for c in patch.columns if c not in (key, seq)]

    def last(c: str) -> Column:
        order = [F.col(seq)] if seq is not None else []
        given = F.struct(*order, F.col(c).alias("value"))
        return F.max(given if nulls else F.when(F.col(c).isNotNull(), given)).getField("value").alias(c)

    # Combined inside the map tasks; the join reuses the partitioning by key.
    patch = patch.where(F.col(key).isNotNull()).groupBy(key).agg(*map(last, fields))
    patch = patch.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__new_{c}") for c in fields])
    joined = target.join(patch, F.col(key) == F.col("__key"), "left")

    def merged(f: T.StructField) -> Column:
        old, new = F.col(f"`{f.name}`"), F.col(f"`__new_{f.name}`")
        kept = _overlay(old, new, f.dataType)
        return F.when(F.col("__key").isNotNull() & new.isNull(), F.lit(None).cast(f.dataType)).otherwise(
            kept) if nulls else kept
    return joined.select(*[merged(f).alias(f.name) if f.name in fields else F.col(f"`{f.name}`")
                           for f in target.schema.fields])


def _overlay(old: Column, new: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StructType):
        merged = F.struct(*[_overlay(old.getField(f.name), new.getField(f.name), f.dataType)
                            .alias(f.name) for f in dtype.fields])
        return F.when(new.isNull(), old).otherwise(merged)
    return F.coalesce(new.cast(dtype), old)


def unmatched(target: DataFrame, patch: DataFrame, key: str = ID) -> DataFrame:
    """Ids of ``patch`` that the target does not hold; a null id is one of them."""
    asked = patch.select(key).distinct()
    met = target.select(F.col(key).alias("__key")).join(
        asked, F.col("__key") == F.col(key), "left_semi").distinct()
    return asked.join(met, F.col(key) == F.col("__key"), "left_anti")


# -- report ------------------------------------------------------------------------
# Pieces a batch is cut into, by order, when the outcome of each operation is worked out.
_SEQ_PIECES = 100


def bulk_report(target: DataFrame, ops: DataFrame, key: str = ID, seq: str = "seq",
                op: str = "op") -> DataFrame:
    """Outcome of every operation, in the order given by ``seq``.

    Columns: seq, op, key, result (created, updated, deleted, not_found), status,
    error.  Each operation has one row, those without a key too.  Whether an operation finds its document depends on the one before it
    on the same key.  The batch is cut into pieces by quantiles of ``seq``, and a
    key is looked at one piece at a time, so a key with a large share of the
    operations never has to fit one task.
    """
    ops = ops.select(seq, op, key)
    known, named = F.col(op).isin(INDEX, DELETE), F.col(key).isNotNull()
    steps = [F.lit(i / _SEQ_PIECES) for i in range(1, _SEQ_PIECES)]
    cuts = ops.where(known & named).agg(F.approx_percentile(seq, F.array(*steps)).alias("c")).select("c")
    # A scalar subquery: at most 99 numbers, whatever the size of the batch.
    rows = ops.where(known & named).withColumn("__cuts", cuts.scalar())
    rows = rows.withColumn("__piece", F.size(F.filter("__cuts", lambda c: c < F.col(seq))))
    rows = rows.drop("__cuts")
    in_order = Window.partitionBy(key, "__piece").orderBy(seq)
    # Per key and piece: how the piece before ended, or else whether the target holds the key.
    # This frame is small and joins on the partitioning the rows already have.
    ends = rows.groupBy(key, "__piece").agg(F.max(F.struct(seq, op)).getField(op).alias("__end"))
    across = Window.partitionBy(key).orderBy("__piece")
    ends = ends.select(key, "__piece", F.lag("__end").over(across).alias("__earlier"))
    held = target.select(F.col(key).alias("__held")).join(
        ends.where(F.col("__earlier").isNull()).select(key), F.col("__held") == F.col(key),
        "left_semi")
    ends = ends.join(held, F.col(key) == F.col("__held"), "left")
    rows = rows.withColumn("__before", F.lag(op).over(in_order)).join(ends, [key, "__piece"])
    before = F.coalesce(F.col("__before"), F.col("__earlier"))
    found = F.when(before.isNotNull(), before == INDEX).otherwise(F.col("__held").isNotNull())
    result = F.when(F.col(op) == INDEX, F.when(found, "updated").otherwise("created")).otherwise(
        F.when(found, "deleted").otherwise("not_found"))
    status = (F.when(result == "created", 201).when(result == "not_found", 404).otherwise(200))
    done = rows.select(seq, op, key, result.alias("result"), status.alias("status"),
                       F.lit(None).cast("string").alias("error"))
    bad = ops.where(~holds(known)).select(
        seq, op, key, F.lit(None).cast("string").alias("result"), F.lit(400).alias("status"),
        F.lit("unknown operation").alias("error"))
    # Without a key, an index operation makes a document of its own and a delete finds none.
    new = F.col(op) == INDEX
    loose = ops.where(known & ~named).select(
        seq, op, key, F.when(new, "created").otherwise("not_found").alias("result"),
        F.when(new, 201).otherwise(404).alias("status"), F.lit(None).cast("string").alias("error"))
    return done.unionByName(loose).unionByName(bad)


def bulk_summary(report: DataFrame) -> DataFrame:
    """``(items, errors)`` of a report."""
    return report.agg(F.count(F.lit(1)).alias("items"),
                      F.coalesce(F.bool_or(F.col("error").isNotNull()), F.lit(False))
                      .alias("errors"))
