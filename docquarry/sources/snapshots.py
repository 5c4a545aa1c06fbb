"""A keyed collection kept as immutable Parquet folders and a commit log.

Spark deletes a path before it reads it when both happen in one overwrite, so a
change is always written to a new folder and made visible by one appended log
row.  Readers resolve the log when they start and are never disturbed; a failed
write leaves a folder that no log row names.

Rows are laid out in buckets by a hash of the key.  A change rewrites only the
buckets it touches and the log row carries the other buckets over.  Choose the
number of buckets so that one holds a few gigabytes.

The log has one writer at a time, as a streaming query or a scheduled job is.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass
from typing import Any
from uuid import uuid4

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.operators.mutate import (
    apply_ops, delete_by_ids, delete_by_query, merge_fields, unmatched, update_by_query, upsert,
    with_ids)
from docquarry.operators.search import ID, get_by_ids
from docquarry.session import shared_folder

_BUCKET = "__bucket"
_LOG = ("version long, parent long, at timestamp, action string, committed boolean, "
        "schema string, folders array<string>, token string, detail string")


@dataclass(frozen=True)
class Commit:
    """One log row."""

    version: int
    parent: int | None
    at: Any
    action: str
    committed: bool
    schema: T.StructType
    folders: tuple[str, ...]
    token: str | None
    detail: dict[str, Any]


class SnapshotTable:
    """Versioned storage of one collection under ``root``."""

    def __init__(self, spark: SparkSession, root: str, key: str = ID, buckets: int = 32) -> None:
        self.spark, self.root, self.key, self.buckets = spark, root.rstrip("/"), key, buckets

    @classmethod
    def create(cls, df: DataFrame, root: str | None = None, key: str = ID,
               buckets: int = 32) -> SnapshotTable:
        """Store ``df`` as version 1, by default in a new shared folder."""
        spark = df.sparkSession
        root = root or f"{shared_folder(spark)}/collections/{uuid4().hex}"
        table = cls(spark, root, key, buckets)
        table.replace(df, "create")
        return table

    # -- reading -----------------------------------------------------------
    def log(self) -> DataFrame:
        return self.spark.read.schema(_LOG).json(f"{self.root}/log")

    def commit(self, version: int | None = None) -> Commit | None:
        """The newest commit, or a given one."""
        try:
            rows = self.log().where("committed")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        if version is not None:
            rows = rows.where(F.col("version") == version)
        found = rows.orderBy(F.desc("version")).limit(1).collect()
        return _commit(found[0]) if found else None

    def read(self, version: int | None = None) -> DataFrame:
        return self._read(self._expect(version))

    def get(self, ids: Iterable[Any]) -> DataFrame:
        """The documents with these ids, reading only the buckets they can be in."""
        ids = list(ids)
        current = self._expect()
        keys = self.spark.createDataFrame(
            [(i,) for i in ids], T.StructType([current.schema[self.key]]))
        asked = self._buckets_of(keys)
        folders = tuple(f for f in current.folders if _bucket_of(f) in asked)
        return get_by_ids(self._read(current, folders), ids, self.key)

    def _expect(self, version: int | None = None) -> Commit:
        commit = self.commit(version)
        if commit is None:
            raise LookupError(f"no version {version or ''} under {self.root}")
        return commit

    def _read(self, commit: Commit, folders: tuple[str, ...] | None = None) -> DataFrame:
        folders = commit.folders if folders is None else folders
        if not folders:
            return self.spark.createDataFrame([], commit.schema)
        return self.spark.read.schema(commit.schema).parquet(
            *[f"{self.root}/data/{f}" for f in folders])

    # -- writing -----------------------------------------------------------
    def replace(self, df: DataFrame, action: str = "write", **log: Any) -> int:
        """Store ``df`` as the whole collection."""
        return self.record(action, schema=df.schema, folders=self.write(df), **log)

    def write(self, df: DataFrame) -> tuple[str, ...]:
        """Write rows to new bucket folders, not yet visible to readers."""
        folder = uuid4().hex
        path = f"{self.root}/data/{folder}"
        # Rebalancing gathers each bucket into files of the advisory size, splitting large ones.
        rows = df.withColumn(_BUCKET, self._bucket()).hint("rebalance", _BUCKET)
        # In order of the key, so that a lookup skips row groups.
        rows = rows.sortWithinPartitions(_BUCKET, self.key)
        rows.write.partitionBy(_BUCKET).parquet(path)
        schema = T.StructType().add(self.key, df.schema[self.key].dataType)
        written = self.spark.read.schema(schema.add(_BUCKET, T.IntegerType())).parquet(path)
        found = written.select(_BUCKET).distinct().collect()  # at most `buckets` numbers
        return tuple(sorted(f"{folder}/{_BUCKET}={r[0]}" for r in found))

    def rewrite(self, keys: DataFrame, change: Callable[[DataFrame], DataFrame],
                action: str = "write", **log: Any) -> int:
        """Apply ``change`` to the buckets that hold ``keys`` and commit the result."""
        current = self._expect()
        touched = self._buckets_of(keys)
        hit = tuple(f for f in current.folders if _bucket_of(f) in touched)
        kept = tuple(f for f in current.folders if _bucket_of(f) not in touched)
        changed = change(self._read(current, hit))
        return self.record(action, schema=changed.schema,
                           folders=kept + self.write(changed), **log)

    def upsert(self, source: DataFrame, seq: str | None = None) -> int:
        source = self._with_ids(source)
        with _kept(source) as rows:
            return self.rewrite(rows, lambda now: upsert(now, rows, self.key, seq), "upsert")

    def _with_ids(self, source: DataFrame) -> DataFrame:
        """Rows with generated ids written down: an id has to be the same when its bucket is
        found and when it is written."""
        if not isinstance(source.schema[self.key].dataType, T.StringType):
            return source
        path = f"{self.root}/incoming/{uuid4().hex}"
        with_ids(source, self.key).write.parquet(path)
        return self.spark.read.schema(source.schema).parquet(path)

    def delete(self, ids: DataFrame) -> int:
        with _kept(ids.select(self.key)) as rows:
            return self.rewrite(rows, lambda now: delete_by_ids(now, rows, self.key), "delete")

    def apply(self, ops: DataFrame, seq: str = "seq", op: str = "op") -> int:
        with _kept(self._with_ids(ops)) as rows:
            return self.rewrite(rows, lambda now: apply_ops(now, rows, self.key, seq, op), "apply")

    def update_where(self, where: Column, updates: Mapping[str, Any]) -> int:
        """Set fields on the documents that match; other buckets stay as they are."""
        if any(path.partition(".")[0] == self.key for path in updates):
            raise ValueError(f"the key {self.key!r} can't be updated")
        return self.rewrite(self.read().where(where),
                            lambda now: update_by_query(now, where, updates, self.key), "update")

    def delete_where(self, where: Column) -> int:
        return self.rewrite(self.read().where(where),
                            lambda now: delete_by_query(now, where), "delete")

    def merge(self, patch: DataFrame, seq: str | None = None, nulls: bool = False,
              missing: str = "error") -> int:
        """Merge fields into stored documents.

        An id the collection doesn't hold is an error, or passed over with
        ``missing="skip"``; :func:`~docquarry.operators.mutate.unmatched` lists such ids.
        """
        with _kept(patch) as rows:
            if missing != "skip":
                found = unmatched(self.read(), rows, self.key).limit(3).collect()
                if found:
                    raise LookupError(f"no documents {[r[0] for r in found]}")
            return self.rewrite(rows, lambda now: merge_fields(now, rows, self.key, seq, nulls), "merge")

    def record(self, action: str, *, schema: T.StructType, folders: tuple[str, ...],
               committed: bool = True, token: str | None = None,
               detail: dict[str, Any] | None = None) -> int:
        """Append one log row; a committed row is the new version."""
        newest = self.commit()
        parent = newest.version if newest else None
        version = (parent or 0) + 1 if committed else (parent or 0)
        row = (version, parent, action, committed, schema.json(), list(folders), token,
               json.dumps(detail or {}))
        columns = [c.split()[0] for c in _LOG.split(", ")]
        types = _LOG.replace("at timestamp, ", "")
        (self.spark.createDataFrame([row], types).withColumn("at", F.current_timestamp())
         .select(*columns).coalesce(1).write.mode("append").json(f"{self.root}/log"))
        return version

    def _buckets_of(self, keys: DataFrame) -> set[int]:
        """Buckets the keys fall into: at most ``buckets`` numbers."""
        return {r[0] for r in keys.select(self._bucket()).distinct().collect()}

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int").alias(_BUCKET)


@contextmanager
def _kept(changes: DataFrame) -> Iterator[DataFrame]:
    """A batch of changes is read several times while it is applied."""
    rows = changes.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows
    finally:
        rows.unpersist()


def _bucket_of(folder: str) -> int:
    return int(folder.rsplit("=", 1)[1])


def _commit(row: Any) -> Commit:
    return Commit(row.version, row.parent, row.at, row.action, row.committed,
                  T.StructType.fromJson(json.loads(row.schema)), tuple(row.folders or ()),
                  row.token, json.loads(row.detail))
