"""Micro-batch sink that keeps a keyed collection up to date from a change stream."""

from __future__ import annotations

from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from docquarry.operators.mutate import DELETE, last_per_key, with_ids
from docquarry.sources.snapshots import SnapshotTable

# Stored next to the document: order of its last change, and whether that was a delete.
SEQ, GONE = "_seq", "_deleted"
# Names of the folders that changes are kept in, and the log detail that says which are merged.
_STREAM, _BATCH, _MERGED = "stream", "batch", "merged"


def collapse(ops: DataFrame, key: str, seq: str, op: str | None) -> DataFrame:
    """The last operation per key of a batch, in stored form; each one without a key."""
    gone = F.lit(False) if op is None else F.col(op) == DELETE
    rows = ops.withColumn(GONE, gone)
    rows = rows.drop(op) if op else rows
    if seq != SEQ:
        rows = rows.withColumnRenamed(seq, SEQ)
    rows = last_per_key(rows, key, SEQ)
    return with_ids(rows, key) if isinstance(rows.schema[key].dataType, T.StringType) else rows


def open_table(stream: DataFrame, root: str, key: str, seq: str, op: str | None = None,
               buckets: int = 32) -> SnapshotTable:
    """The table a stream is kept in, created empty on first use."""
    table = SnapshotTable(stream.sparkSession, root, key, buckets)
    if table.commit() is None:
        empty = stream.sparkSession.createDataFrame([], stream.schema)
        table.record("create", schema=collapse(empty, key, seq, op).schema, folders=())
    return table


def _merged(table: SnapshotTable) -> dict[str, int]:
    """The last batch of each stream that a compaction has merged: one log row."""
    field = F.get_json_object("detail", f"$.{_MERGED}")
    rows = (table.log().where(F.col("committed") & field.isNotNull())
            .orderBy(F.desc("version")).select(F.from_json(field, "map<string,long>").alias("m")).limit(1).collect())
    return rows[0].m if rows else {}


def _pending(table: SnapshotTable) -> DataFrame | None:
    """Appended changes that no compaction has merged yet."""
    schema = T.StructType(table.commit().schema.fields).add(_STREAM, "string").add(_BATCH, "long")
    try:
        rows = table.spark.read.schema(schema).parquet(f"{table.root}/changes")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    for name, batch in _merged(table).items():
        rows = rows.where((F.col(_STREAM) != name) | (F.col(_BATCH) > batch))
    return rows


def stored(table: SnapshotTable) -> DataFrame:
    """The last state of every key over collection and changes, deleted ones as markers.

    Order decides, not arrival: batches may come late or twice.
    """
    base, pending = table.read(), _pending(table)
    if pending is None:
        return base
    return last_per_key(base.unionByName(pending.drop(_STREAM, _BATCH)), table.key, SEQ)


def live(table: SnapshotTable) -> DataFrame:
    """Current documents, without markers and bookkeeping."""
    return stored(table).where(~F.col(GONE)).drop(SEQ, GONE)


def compact(table: SnapshotTable) -> int:
    """Merge the changes into the collection, as one new version.

    Markers of deleted documents stay, so that older changes that come later have no effect.
    Merged change folders are no longer read and may be removed.
    """
    pending = _pending(table)
    if pending is None:
        return table.commit().version
    upto = {r[0]: r[1] for r in pending.groupBy(_STREAM).agg(F.max(_BATCH)).collect()}  # one row a stream
    return table.replace(stored(table), "compact", detail={_MERGED: {**_merged(table), **upto}})


def upsert_stream(stream: DataFrame, table: SnapshotTable, *, key: str, seq: str,
                  checkpoint: str, op: str | None = None, every: str | None = "5 seconds",
                  name: str = "upserts") -> StreamingQuery:
    """Keep ``table`` up to date with a stream of changes.

    Each batch is collapsed per key and written to a folder of its own number; nothing that
    is stored is read or rewritten.  A batch that Spark repeats after a failure overwrites
    its folder, so nothing is lost or applied twice.  Readers use :func:`live`; call
    :func:`compact` between runs once changes outweigh the collection.  ``every=None``
    handles what is available and stops.  Bound the batch size at the source, for example
    with ``maxFilesPerTrigger``.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        collapse(batch, key, seq, op).write.mode("overwrite").parquet(
            f"{table.root}/changes/{_STREAM}={name}/{_BATCH}={batch_id}")

    options: dict[str, Any] = {"processingTime": every} if every else {"availableNow": True}
    return (stream.writeStream.queryName(name).outputMode("append").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**options).start())
