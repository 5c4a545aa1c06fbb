"""Schema migration of a snapshot table: plan, dry run, migrate, roll back, history."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.functions.fields import OPTIONS
from docquarry.functions.predicates import any_of, holds
from docquarry.sources.schema import (
    Field, Schema, convert, mapping_rows, struct_type, type_name, typed_load)
from docquarry.sources.snapshots import SnapshotTable

ADDED, MODIFIED, DELETED = "added", "modified", "deleted"
_HISTORY_ACTIONS = ("migrate", "rollback")


class MigrationError(RuntimeError):
    """A migration that did not complete; the collection is unchanged."""


@dataclass(frozen=True)
class FieldChange:
    field: str
    change: str
    old_type: str | None
    new_type: str | None


@dataclass(frozen=True)
class Plan:
    """What a migration would do."""

    changes: Sequence[FieldChange] = field(default_factory=tuple)

    @property
    def requires_rewrite(self) -> bool:
        return any(c.change != ADDED for c in self.changes)

    def named(self, change: str) -> list[str]:
        return [c.field for c in self.changes if c.change == change]

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(c.field, c.change, c.old_type, c.new_type) for c in self.changes]
        return spark.createDataFrame(
            rows, "field string, change string, old_type string, new_type string")


@dataclass(frozen=True)
class Result:
    migration_id: str
    plan: Plan
    version: int
    backup_version: int | None = None


def plan_changes(old: T.StructType, new: T.StructType) -> Plan:
    """Difference of two schemas, field by field.

    A field counts as modified when its type, its multi-fields or its
    sub-properties differ, or when the same type is stored differently.
    """
    before = {f.name: f for f in old.fields}
    after = {f.name: f for f in new.fields}
    changes = []
    for name, f in after.items():
        if name not in before:
            changes.append(FieldChange(name, ADDED, None, type_name(f)))
        elif _shape(before[name]) != _shape(f):
            changes.append(FieldChange(name, MODIFIED, type_name(before[name]), type_name(f)))
    changes += [FieldChange(n, DELETED, type_name(f), None)
                for n, f in before.items() if n not in after]
    return Plan(tuple(changes))


def _shape(f: T.StructField) -> tuple:
    inner = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
    subs = tuple((p, t) for p, t, _ in mapping_rows(inner)) if isinstance(
        inner, T.StructType) else ()
    return (type_name(f), f.metadata.get(OPTIONS, {}).get("fields"), subs,
            f.dataType.simpleString())


def target_schema(table_schema: T.StructType, schema: Schema, key: str) -> T.StructType:
    """Stored schema of a declared one: the key column always stays."""
    new = struct_type(schema)
    if key in new.fieldNames():
        return new
    return T.StructType([table_schema[key], *new.fields])


def dry_run(table: SnapshotTable, schema: Schema) -> DataFrame:
    """The plan with its effect on the stored data; nothing is written.

    ``stored`` counts the values a changed field holds now and ``unconvertible``
    those its new type cannot take.
    """
    current = table.read()
    plan = plan_changes(current.schema, target_schema(current.schema, schema, table.key))
    bad = _unconvertible(current, schema, plan)
    measures = []
    for i, c in enumerate(plan.changes):
        stored = F.count(F.col(c.field)) if c.change != ADDED else F.lit(0).cast("long")
        lost = F.count_if(bad[c.field]) if c.field in bad else F.lit(0).cast("long")
        measures += [stored.alias(f"stored{i}"), lost.alias(f"bad{i}")]
    if not measures:
        return plan.frame(table.spark).withColumns(
            {"stored": F.lit(0).cast("long"), "unconvertible": F.lit(0).cast("long")})
    totals = current.agg(F.count(F.lit(1)), *measures)
    return totals.select(F.explode(F.array(*[
        F.struct(F.lit(c.field).alias("field"), F.lit(c.change).alias("change"),
                 F.lit(c.old_type).cast("string").alias("old_type"),
                 F.lit(c.new_type).cast("string").alias("new_type"),
                 F.col(f"stored{i}").alias("stored"),
                 F.col(f"bad{i}").alias("unconvertible"))
        for i, c in enumerate(plan.changes)])).alias("c")).select("c.*")


def migrate(table: SnapshotTable, schema: Schema, *, backup: bool = False,
            malformed: str = "fail") -> Result:
    """Move the collection to a new schema.

    Added fields only widen the schema: the stored files stay as they are.  Any
    other change rewrites the rows to new folders and then switches.  Values the
    new type cannot take stop the migration, or become null with
    ``malformed="null"``.  With ``backup`` the version before is kept for
    :func:`rollback`; a failure is logged and leaves the collection as it was.
    """
    before = table.commit()
    current = table.read(before.version)
    stored = target_schema(current.schema, schema, table.key)
    plan = plan_changes(current.schema, stored)
    migration_id = _next_id(table)
    detail = {"id": migration_id, "backup_version": before.version if backup else None,
              "changes": [vars(c) for c in plan.changes]}
    try:
        if plan.requires_rewrite:
            losses = Observation()
            folders = table.write(_rewritten(table, current, schema, plan, losses))
            if malformed == "fail":
                _check(losses)
        else:
            folders = before.folders
    except Exception as error:
        table.record("migrate", schema=current.schema, folders=before.folders, committed=False,
                     detail={**detail, "error": str(error).splitlines()[0]})
        raise
    version = table.record("migrate", schema=stored, folders=folders, detail=detail)
    return Result(migration_id, plan, version, before.version if backup else None)


def _rewritten(table: SnapshotTable, current: DataFrame, schema: Schema, plan: Plan,
               losses: Observation) -> DataFrame:
    """Rows in the new schema; values lost on the way are counted as they are written."""
    lenient = {n: _lenient(f) for n, f in schema.items()}
    counts = [F.count_if(test).alias(n)
              for n, test in _unconvertible(current, schema, plan).items()]
    watched = current.observe(losses, F.count(F.lit(1)).alias("rows"), *counts)
    return typed_load(watched, lenient, table.key)


def _lenient(f: Field) -> Field:
    return replace(f, ignore_malformed=True,
                   properties={n: _lenient(p) for n, p in f.properties.items()})


def _check(losses: Observation) -> None:
    lost = {n: c for n, c in losses.get.items() if n != "rows" and c}
    if lost:
        raise MigrationError(f"values that do not convert, by field: {lost}")


def _unconvertible(current: DataFrame, schema: Schema, plan: Plan) -> dict[str, Column]:
    """Per modified field: a stored value is there and its conversion is not."""
    return {n: holds(_lost(F.col(n), schema[n], current.schema[n].dataType))
            for n in plan.named(MODIFIED) if n in schema}


def _lost(col: Column, f: Field, raw: T.DataType) -> Column:
    if isinstance(raw, T.ArrayType) and (f.many or f.type == "nested"):
        one = replace(f, many=False, type="object" if f.type == "nested" else f.type)
        return F.exists(col, lambda e: holds(_lost(e, one, raw.elementType)))
    if f.type in ("object", "nested") and isinstance(raw, T.StructType):
        parts = [holds(_lost(col.getField(n), p, raw[n].dataType))
                 for n, p in f.properties.items() if n in raw.fieldNames()]
        return any_of(parts) if parts else F.lit(False)
    lenient = replace(f, ignore_malformed=True, default=None, null_value=None)
    return col.isNotNull() & convert(col, lenient, raw).isNull()


def rollback(table: SnapshotTable, migration_id: str) -> int:
    """Go back to the version kept by a migration; possible once per migration."""
    entries = _entries(table, migration_id)
    done = [e for e in entries if e["action"] == "migrate" and e["committed"]]
    if not done:
        raise MigrationError(f"no completed migration {migration_id!r}")
    if any(e["action"] == "rollback" and e["committed"] for e in entries):
        raise MigrationError(f"migration {migration_id!r} was already rolled back")
    kept = done[0]["backup_version"]
    if kept is None:
        raise MigrationError(f"migration {migration_id!r} kept no backup")
    backup = table.commit(kept)
    return table.record("rollback", schema=backup.schema, folders=backup.folders,
                        detail={"id": migration_id, "backup_version": kept, "changes": []})


def history(table: SnapshotTable, limit: int | None = None) -> DataFrame:
    """Migrations and rollbacks, newest first: all, or the last ``limit``."""
    detail = F.from_json("detail", "id string, backup_version long, error string, "
                         "changes array<struct<field:string,change:string,"
                         "old_type:string,new_type:string>>")
    rows = (table.log().where(F.col("action").isin(*_HISTORY_ACTIONS))
            .withColumn("d", detail)
            .select(F.col("d.id").alias("migration_id"), "action",
                    F.col("committed").alias("success"), "version",
                    "d.backup_version", "d.error", "d.changes", "at")
            .orderBy(F.desc("at"), F.desc("version")))
    return rows if limit is None else rows.limit(limit)


def _entries(table: SnapshotTable, migration_id: str) -> list[dict]:
    """The log rows of one migration: itself and its rollbacks."""
    rows = (table.log().where(F.col("action").isin(*_HISTORY_ACTIONS))
            .select("action", "committed",
                    F.get_json_object("detail", "$.id").alias("id"),
                    F.get_json_object("detail", "$.backup_version").cast("long")
                    .alias("backup_version")).where(F.col("id") == migration_id))
    return [r.asDict() for r in rows.collect()]


def _next_id(table: SnapshotTable) -> str:
    return f"m{table.log().where(F.col('action') == 'migrate').count() + 1}"
