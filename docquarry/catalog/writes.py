"""Keyed writes, constraints, the streaming sink and schema migration."""

from __future__ import annotations

from uuid import uuid4

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.catalog.registry import Catalog, Tables
from docquarry.functions import metrics as m
from docquarry.functions.predicates import Fields
from docquarry.operators import constraints, mutate
from docquarry.operators.buckets import metrics
from docquarry.plans import migration
from docquarry.session import shared_folder
from docquarry.sources.schema import Field, mapping_rows
from docquarry.sources.snapshots import SnapshotTable
from docquarry.streaming import upserts

QUERIES = Catalog()
query = QUERIES.query

_BODY = "c_name, c_nationkey, c_acctbal, c_mktsegment"

# Changed customers: every third one moves to a new balance, half of them under a new key.
_CHANGES = """
SELECT CASE WHEN c_custkey % 2 = 0 THEN c_custkey ELSE c_custkey + 10000000 END AS c_custkey,
  c_name, c_nationkey, c_acctbal + 1000 AS c_acctbal, c_mktsegment
FROM customer WHERE c_custkey % 3 = 0"""


def _changes(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    return t.customer.where(key % 3 == 0).select(
        F.when(key % 2 == 0, key).otherwise(key + 10_000_000).alias("c_custkey"),
        "c_name", "c_nationkey", (F.col("c_acctbal") + 1000).alias("c_acctbal"), "c_mktsegment")


@query(f"""
WITH s AS ({_CHANGES})
SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM s) UNION ALL SELECT * FROM s""")
def w1_upsert(t: Tables):
    return mutate.upsert(t.customer, _changes(t), key="c_custkey")


@query("""
WITH s AS (SELECT user_id, max(event_id) AS event_id FROM events GROUP BY 1)
SELECT c_custkey, CASE WHEN s.user_id IS NULL THEN c_name ELSE e.event_type END AS c_name
FROM (SELECT c_custkey, c_name FROM customer UNION ALL SELECT user_id, NULL FROM s
  WHERE user_id NOT IN (SELECT c_custkey FROM customer)) c
LEFT JOIN s ON c_custkey = s.user_id LEFT JOIN events e ON e.event_id = s.event_id""")
def w1_upsert_last_wins(t: Tables):
    """A source that repeats keys: the highest sequence number wins."""
    source = t.events.select(F.col("user_id").alias("c_custkey"),
                             F.col("event_type").alias("c_name"), "event_id")
    return mutate.upsert(t.customer.select("c_custkey", "c_name"), source, key="c_custkey",
                         seq="event_id")


@query("""
SELECT count(*) + (SELECT count(*) FROM supplier) AS docs,
  count(*) + (SELECT count(*) FROM supplier) AS ids FROM customer""")
def w1_generated_ids(t: Tables):
    """Documents without an id get one each."""
    target = t.customer.select(F.concat(F.lit("c"), "c_custkey").alias("_id"), "c_name")
    source = t.supplier.select(F.lit(None).cast("string").alias("_id"),
                               F.col("s_name").alias("c_name"))
    return metrics(mutate.upsert(target, source), {
        "docs": m.value_count("_id"), "ids": F.count_distinct("_id")})


@query("""
SELECT * FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)""")
def w2_delete_by_ids(t: Tables):
    ids = t.orders.where(Fields(t.orders).range("o_totalprice", gt=450000))
    return mutate.delete_by_ids(
        t.customer,
        ids.select(F.col("o_custkey").alias("c_custkey")), key="c_custkey")


# A batch that indexes, deletes and repeats keys; one operation in 101 is unknown.
_OPS = f"""
SELECT c_custkey * 2 AS c_custkey, c_custkey AS seq, CASE WHEN c_custkey % 3 = 0 THEN 'delete'
  WHEN c_custkey % 101 = 0 THEN 'patch' ELSE 'index' END AS op, {_BODY} FROM customer
UNION ALL SELECT c_custkey, c_custkey + 50000000, 'delete', {_BODY} FROM customer WHERE c_custkey % 5 = 0
UNION ALL SELECT c_custkey, c_custkey + 90000000, 'index', upper(c_name), c_nationkey, c_acctbal,
  c_mktsegment FROM customer WHERE c_custkey % 10 = 0"""
_APPLIED = f"""
WITH o AS ({_OPS}), k AS (SELECT * FROM o WHERE op IN ('index', 'delete')),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY seq DESC) AS place
  FROM k) WHERE place = 1)
SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM l)
UNION ALL SELECT c_custkey, {_BODY} FROM l WHERE op = 'index'"""


def _ops(t: Tables) -> DataFrame:
    key, body = F.col("c_custkey"), _BODY.split(", ")
    first = t.customer.select(
        (key * 2).alias("c_custkey"), key.alias("seq"),
        F.when(key % 3 == 0, "delete").when(key % 101 == 0, "patch").otherwise("index").alias("op"),
        *body)
    second = t.customer.where(key % 5 == 0).select(
        key, (key + 50_000_000).alias("seq"), F.lit("delete").alias("op"), *body)
    third = t.customer.where(key % 10 == 0).select(
        key, (key + 90_000_000).alias("seq"), F.lit("index").alias("op"),
        F.upper("c_name").alias("c_name"), *body[1:])
    return first.unionByName(second).unionByName(third)


@query(_APPLIED)
def w3_mixed_batch(t: Tables):
    return mutate.apply_ops(t.customer, _ops(t), key="c_custkey")


@query(_APPLIED)
def w3_mixed_batch_stored(t: Tables):
    """The same batch on a stored collection: a new snapshot, then read back."""
    table = SnapshotTable.create(t.customer, key="c_custkey", buckets=4)
    table.apply(_ops(t))
    return table.read()


@query("""
SELECT c_custkey, c_name, c_nationkey,
  CASE WHEN coalesce(c_mktsegment = 'BUILDING', false) THEN c_acctbal * 2 ELSE c_acctbal END AS c_acctbal,
  CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS c_mktsegment
FROM customer""")
def w4_update_by_query(t: Tables):
    q = Fields(t.customer)
    return mutate.update_by_query(t.customer, q.match_each({"c_mktsegment": "BUILDING"}), {
        "c_acctbal": F.col("c_acctbal") * 2, "c_mktsegment": None})


@query("""
SELECT c_custkey, c_name, CASE WHEN c_nationkey = 3 AND c_mktsegment = 'MACHINERY' THEN 'moved'
  ELSE c_mktsegment END AS segment, CASE WHEN c_nationkey = 3 AND c_mktsegment = 'MACHINERY'
  THEN 99 ELSE c_nationkey END AS nation FROM customer""")
def w4_update_object(t: Tables):
    """Members of an object are set one by one; the others stay."""
    docs = t.customer.select("c_custkey", F.struct(
        "c_name", F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation")).alias("who"))
    q = Fields(docs)
    out = mutate.update_by_query(
        docs, q.match_each({"who.nation": 3, "who.segment": "MACHINERY"}),
        {"who": {"segment": "moved"}, "who.nation": 99})
    return out.select("c_custkey", "who.*")


@query("SELECT event_id, value FROM events WHERE NOT coalesce(nullif(event_type, 'view') = 'error', false)")
def w5_delete_by_query(t: Tables):
    docs = t.events.select("event_id", "value", F.nullif(
        F.col("event_type"), F.lit("view")).alias("kind"))
    gone = Fields(docs).match_each({"kind": "error"})
    return mutate.delete_by_query(docs, gone).drop("kind")


@query("""
WITH p AS (SELECT o_custkey, max(o_orderpriority) AS last_priority,
  arg_max(o_orderpriority, o_orderkey) FILTER (WHERE o_orderstatus <> 'O') AS seg,
  arg_max(o_totalprice, o_orderkey) AS bal FROM orders GROUP BY 1)
SELECT c_custkey, c_name, c_nationkey, coalesce(bal, c_acctbal) AS c_acctbal,
  coalesce(seg, c_mktsegment) AS c_mktsegment
FROM customer LEFT JOIN p ON o_custkey = c_custkey""")
def w6_merge_fields(t: Tables):
    """Several patches per key: the last value given for each field is kept."""
    patch = t.orders.select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey",
        F.col("o_totalprice").alias("c_acctbal"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderpriority")).alias("c_mktsegment"))
    return mutate.merge_fields(t.customer, patch, key="c_custkey", seq="o_orderkey")


@query(f"""
WITH s AS ({_CHANGES}) SELECT c_custkey FROM s WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)""")
def w6_unmatched(t: Tables):
    return mutate.unmatched(t.customer, _changes(t), key="c_custkey")


@query("""
SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
  CASE WHEN c_custkey % 3 = 0 THEN 'merged' ELSE c_mktsegment END AS c_mktsegment
FROM customer WHERE c_custkey % 5 <> 0""")
def w4_w5_w6_stored(t: Tables):
    """Update, delete and merge on a stored collection, one snapshot each."""
    table = SnapshotTable.create(t.customer, key="c_custkey", buckets=4)
    table.update_where(F.col("c_custkey") % 2 == 0, {"c_acctbal": F.col("c_acctbal") + 1})
    table.delete_where(F.col("c_custkey") % 5 == 0)
    table.merge(t.customer.where(F.col("c_custkey") % 3 == 0).select(
        "c_custkey", F.lit("merged").alias("c_mktsegment")), missing="skip")
    return table.read()


@query("""
SELECT event_id, ts, user_id, event_type, value, props FROM (SELECT *, row_number() OVER
  (PARTITION BY user_id ORDER BY event_id DESC) AS place FROM events)
WHERE place = 1 AND event_type <> 'error'""")
def w7_upsert_stream(t: Tables):
    """Events streamed into a keyed collection; an error event deletes its user."""
    return upserts.live(_streamed(t, F.col("user_id"), 4)[0])


def _streamed(t: Tables, user: Column, files: int) -> tuple[SnapshotTable, str]:
    """A collection kept from a stream of ``files`` batches, each with every ``files``-th event:
    all but the first come late for some users."""
    folder = f"{shared_folder(t.spark)}/streams/{uuid4().hex}"
    events = t.events.withColumn("user_id", user)
    table = None
    for run in ("once", "again"):  # the second run repeats every batch
        for i in range(files):  # a batch is what has come since the last one, in any number of files
            events.where(F.col("event_id") % files == (i * 3 + 1) % files).write.mode("append").parquet(f"{folder}/{run}")
            changes = t.spark.readStream.schema(events.schema).parquet(f"{folder}/{run}").withColumns({
                "op": F.when(F.col("event_type") == "error", "delete").otherwise("index"),
                "seq": F.col("event_id")})
            table = table or upserts.open_table(changes, f"{folder}/table", "user_id", "seq", "op", buckets=4)
            upserts.upsert_stream(changes, table, key="user_id", seq="seq", op="op", every=None,
                                  checkpoint=f"{folder}/checkpoint-{run}").awaitTermination()
    return table, folder


@query("""
SELECT event_id, ts, user_id, event_type, value, props FROM (SELECT *, row_number() OVER
  (PARTITION BY user_id ORDER BY event_id DESC) AS place FROM events)
WHERE place = 1 AND event_type <> 'error'""")
def w7_compacted_stream(t: Tables):
    """The same after the changes are merged into the collection."""
    table, _ = _streamed(t, F.col("user_id"), 4)
    upserts.compact(table)
    return table.read().where(~F.col(upserts.GONE)).drop(upserts.SEQ, upserts.GONE)


@query("""
SELECT (SELECT count(*) FROM events WHERE user_id % 3 = 0 AND event_type <> 'error') + (SELECT count(*) FROM (
  SELECT event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS place
  FROM events WHERE user_id % 3 <> 0) WHERE place = 1 AND event_type <> 'error') AS docs,
  (SELECT count(*) FROM events WHERE user_id % 3 = 0 AND event_type <> 'error') + (SELECT count(*) FROM (
  SELECT event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS place
  FROM events WHERE user_id % 3 <> 0) WHERE place = 1 AND event_type <> 'error') AS ids""")
def w7_stream_without_ids(t: Tables):
    """Events of every third user have no key: each is a document of its own."""
    user = F.when(F.col("user_id") % 3 != 0, F.col("user_id").cast("string"))
    return metrics(upserts.live(_streamed(t, user, 4)[0]), {
        "docs": F.count(F.lit(1)), "ids": F.count_distinct("user_id")})


# A third of a batch has no id; the rest repeats ids.
_LOOSE = """
SELECT CASE WHEN event_id % 3 <> 0 THEN 'c' || user_id END AS _id, event_id AS seq,
  CASE WHEN event_type = 'error' THEN 'delete' ELSE 'index' END AS op, event_type AS c_name FROM events"""


def _loose(t: Tables) -> DataFrame:
    return t.events.select(
        F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("c"), "user_id")).alias("_id"),
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "error", "delete").otherwise("index").alias("op"),
        F.col("event_type").alias("c_name"))


def _named(t: Tables) -> DataFrame:
    return t.customer.select(F.concat(F.lit("c"), "c_custkey").alias("_id"), "c_name")


_COUNTED = "SELECT c_name, count(*) AS docs, count(DISTINCT _id) AS ids FROM d GROUP BY 1"


def _counted(docs: DataFrame) -> DataFrame:
    return docs.groupBy("c_name").agg(F.count(F.lit(1)).alias("docs"),
                                      F.count_distinct("_id").alias("ids"))


@query(f"""
WITH o AS ({_LOOSE}), l AS (SELECT coalesce(_id, 'new' || seq) AS _id, c_name, row_number() OVER (
  PARTITION BY coalesce(_id, 'new' || seq) ORDER BY seq DESC) AS place FROM o),
d AS (SELECT _id, c_name FROM l WHERE place = 1 UNION ALL SELECT 'c' || c_custkey, c_name FROM customer
  WHERE 'c' || c_custkey NOT IN (SELECT _id FROM l)) {_COUNTED}""")
def w1_upsert_without_ids(t: Tables):
    return _counted(mutate.upsert(_named(t), _loose(t).drop("op"), seq="seq"))


_MIXED = f"""
WITH o AS ({_LOOSE}), l AS (SELECT coalesce(_id, 'new' || seq) AS _id, op, c_name, row_number() OVER (
  PARTITION BY coalesce(_id, 'new' || seq) ORDER BY seq DESC) AS place FROM o),
d AS (SELECT _id, c_name FROM l WHERE place = 1 AND op = 'index' UNION ALL SELECT 'c' || c_custkey, c_name
  FROM customer WHERE 'c' || c_custkey NOT IN (SELECT _id FROM l)) {_COUNTED}"""


@query(_MIXED)
def w3_without_ids(t: Tables):
    return _counted(mutate.apply_ops(_named(t), _loose(t)))


@query(_MIXED)
def w3_without_ids_stored(t: Tables):
    table = SnapshotTable.create(_named(t), buckets=4)
    table.apply(_loose(t))
    return _counted(table.read())


@query(f"""
WITH o AS ({_LOOSE}), b AS (SELECT *, lag(op) OVER (PARTITION BY coalesce(_id, 'new' || seq) ORDER BY seq) AS before FROM o),
f AS (SELECT *, CASE WHEN before IS NOT NULL THEN before = 'index'
  ELSE coalesce(_id IN (SELECT 'c' || c_custkey FROM customer), false) END AS found FROM b),
r AS (SELECT seq, op, _id, CASE WHEN op = 'index' THEN CASE WHEN found THEN 'updated'
  ELSE 'created' END WHEN found THEN 'deleted' ELSE 'not_found' END AS result FROM f)
SELECT *, CASE result WHEN 'created' THEN 201 WHEN 'not_found' THEN 404 ELSE 200 END AS status,
  CAST(NULL AS VARCHAR) AS error FROM r""")
def w8_without_ids(t: Tables):
    """One row for each operation, those without an id too."""
    return mutate.bulk_report(_named(t), _loose(t))


@query("""
WITH p AS (SELECT o_custkey, max(o_orderkey) AS last FROM orders GROUP BY 1)
SELECT c_custkey, c_name, c_nationkey, CASE WHEN last IS NULL THEN c_acctbal
  WHEN o_orderstatus <> 'O' THEN o_totalprice END AS c_acctbal, c_mktsegment
FROM customer LEFT JOIN p ON p.o_custkey = c_custkey LEFT JOIN orders ON o_orderkey = last""")
def w6_merge_nulls(t: Tables):
    """A patch whose nulls count: the last order sets the balance or clears it."""
    patch = t.orders.select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey",
        F.when(F.col("o_orderstatus") != "O", F.col("o_totalprice")).alias("c_acctbal"))
    return mutate.merge_fields(t.customer, patch, key="c_custkey", seq="o_orderkey", nulls=True)


_REPORT = f"""
WITH o AS ({_OPS}), k AS (SELECT seq, op, c_custkey FROM o WHERE op IN ('index', 'delete')),
b AS (SELECT *, lag(op) OVER (PARTITION BY c_custkey ORDER BY seq) AS before FROM k),
f AS (SELECT *, CASE WHEN before IS NOT NULL THEN before = 'index'
  ELSE c_custkey IN (SELECT c_custkey FROM customer) END AS found FROM b),
r AS (SELECT seq, op, c_custkey, CASE WHEN op = 'index' THEN CASE WHEN found THEN 'updated'
  ELSE 'created' END WHEN found THEN 'deleted' ELSE 'not_found' END AS result FROM f)
SELECT *, CASE result WHEN 'created' THEN 201 WHEN 'not_found' THEN 404 ELSE 200 END AS status,
  CAST(NULL AS VARCHAR) AS error FROM r
UNION ALL SELECT seq, op, c_custkey, NULL, 400, 'unknown operation' FROM o
WHERE op NOT IN ('index', 'delete')"""


@query(_REPORT)
def w8_bulk_report(t: Tables):
    return mutate.bulk_report(t.customer, _ops(t), key="c_custkey")


@query(f"SELECT count(*) AS items, coalesce(bool_or(error IS NOT NULL), false) AS errors FROM ({_REPORT})")
def w8_bulk_summary(t: Tables):
    return mutate.bulk_summary(mutate.bulk_report(t.customer, _ops(t), key="c_custkey"))


# -- constraints ---------------------------------------------------------------------
_PEOPLE = """
SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN c_name END AS name, c_acctbal AS balance,
  CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS segment FROM customer"""


def _people(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    return t.customer.select(
        key, F.when(key % 4 != 0, F.col("c_name")).alias("name"),
        F.col("c_acctbal").alias("balance"),
        F.struct(F.when(key % 5 != 0, F.col("c_mktsegment")).alias("segment")).alias("market"))


_RULES = {
    "name": Field("text", required=True),
    "balance": Field("double", validate=lambda c: c >= 0),
    "market": Field("object", properties={
        "segment": Field("keyword", required=True, validate=lambda c: c.rlike("^[A-M]"))}),
}


@query(f"""
WITH p AS ({_PEOPLE})
SELECT c_custkey, 'name' AS field, 'required' AS rule FROM p WHERE name IS NULL
UNION ALL SELECT c_custkey, 'balance', 'validate' FROM p WHERE balance < 0
UNION ALL SELECT c_custkey, 'market.segment', 'required' FROM p WHERE segment IS NULL
UNION ALL SELECT c_custkey, 'market.segment', 'validate' FROM p
  WHERE NOT regexp_matches(segment, '^[A-M]')""")
def c1_violations(t: Tables):
    return constraints.violations(_people(t), _RULES, key="c_custkey")


@query(f"""
SELECT c_custkey, balance FROM ({_PEOPLE}) WHERE name IS NOT NULL AND balance >= 0
  AND regexp_matches(segment, '^[A-M]')""")
def c2_valid(t: Tables):
    return constraints.valid(_people(t), _RULES).select("c_custkey", "balance")


@query(f"""
SELECT c_custkey, (name IS NULL)::BIGINT + (balance < 0)::BIGINT + (segment IS NULL)::BIGINT
  + coalesce(NOT regexp_matches(segment, '^[A-M]'), false)::BIGINT AS broken FROM ({_PEOPLE})
WHERE name IS NULL OR balance < 0 OR segment IS NULL OR NOT regexp_matches(segment, '^[A-M]')""")
def c2_rejected(t: Tables):
    return constraints.rejected(_people(t), _RULES).select(
        "c_custkey", F.size("violations").cast("long").alias("broken"))


@F.pandas_udf(T.BooleanType())
def _checksum(names: pd.Series) -> pd.Series:
    """A caller's rule that no Column says: digits of the name add up to a multiple of three."""
    digits = names.str.extractall("([0-9])")[0].astype(int).groupby(level=0).sum()
    return digits.reindex(names.index, fill_value=0) % 3 == 0


@query("""
SELECT c_custkey, 'c_name' AS field, 'validate' AS rule FROM customer
WHERE list_sum(list_transform(regexp_extract_all(c_name, '[0-9]'), lambda d: CAST(d AS INTEGER))) % 3 <> 0""")
def u1_validator_callback(t: Tables):
    """A callback over whole batches of values, as a pandas UDF."""
    rules = {"c_name": Field("keyword", validate=_checksum)}
    return constraints.violations(t.customer, rules, key="c_custkey").select("c_custkey", "field", "rule")


@query(f"""
SELECT c_custkey, coalesce(name, 'anonymous') AS name, coalesce(segment, 'none') AS segment,
  CAST(c_custkey AS VARCHAR) AS label FROM ({_PEOPLE})""")
def c3_defaults(t: Tables):
    docs = _people(t).select("c_custkey", "name", "market.segment")
    return constraints.with_defaults(docs, {
        "name": "anonymous", "segment": lambda: F.lit("none"),
        "label": F.col("c_custkey").cast("string")})


# -- migration ------------------------------------------------------------------------
_NEW_PART = {
    "p_partkey": Field("long"),
    "p_name": Field("keyword"),
    "p_brand": Field("integer", ignore_malformed=True),
    "p_size": Field("long"),
    "p_retailprice": Field("double"),
    "p_note": Field("keyword"),
}


def _part_table(t: Tables) -> SnapshotTable:
    return SnapshotTable.create(t.part, key="p_partkey", buckets=4)


@query("""
SELECT 'p_brand' AS field, 'modified' AS change, 'keyword' AS old_type, 'integer' AS new_type,
  count(p_brand) AS stored, count(*) FILTER (WHERE TRY_CAST(p_brand AS INTEGER) IS NULL) AS unconvertible
FROM part
UNION ALL SELECT 'p_size', 'modified', 'integer', 'long', count(p_size), 0 FROM part
UNION ALL SELECT 'p_note', 'added', NULL, 'keyword', 0, 0 FROM part HAVING true
UNION ALL SELECT 'p_type', 'deleted', 'keyword', NULL, count(p_type), 0 FROM part""")
def m1_m3_plan_dry_run(t: Tables):
    return migration.dry_run(_part_table(t), _NEW_PART)


@query("""
SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size, p_retailprice,
  CAST(NULL AS VARCHAR) AS p_note FROM part""")
def m2_migrate_rewrite(t: Tables):
    table = _part_table(t)
    migration.migrate(table, {k: f for k, f in _NEW_PART.items() if k != "p_brand"})
    return table.read()


@query("SELECT *, CAST(NULL AS VARCHAR) AS p_note FROM part")
def m2_migrate_add_field(t: Tables):
    """Only added fields: no file is rewritten."""
    table = _part_table(t)
    migration.migrate(table, {
        "p_partkey": Field("long"), "p_name": Field("keyword"), "p_brand": Field("keyword"),
        "p_type": Field("keyword"), "p_size": Field("integer"),
        "p_retailprice": Field("double"), "p_note": Field("keyword")})
    return table.read()


@query("SELECT * FROM part")
def m4_m6_backup_rollback(t: Tables):
    table = _part_table(t)
    done = migration.migrate(table, {k: f for k, f in _NEW_PART.items() if k != "p_brand"},
                             backup=True)
    migration.rollback(table, done.migration_id)
    return table.read()


@query("SELECT * FROM part")
def m5_failed_migration(t: Tables):
    """A value that does not convert stops the migration; the collection is as before."""
    table = _part_table(t)
    try:
        migration.migrate(table, _NEW_PART, backup=True)
    except migration.MigrationError:
        return table.read()
    raise AssertionError("the migration should have failed")


@query("""
SELECT 'm1' AS migration_id, 'migrate' AS action, true AS success, 2::BIGINT AS version,
  1::BIGINT AS backup_version, CAST(NULL AS VARCHAR) AS error, 'p_brand deleted,p_note added,p_size modified,p_type deleted' AS changes,
  count(p_partkey) AS docs FROM part
UNION ALL SELECT 'm1', 'rollback', true, 3, 1, NULL, '', count(p_partkey) FROM part""")
def m7_history(t: Tables):
    """The history, with the number of documents at each of its versions."""
    table = _part_table(t)
    done = migration.migrate(table, {k: f for k, f in _NEW_PART.items() if k != "p_brand"},
                             backup=True)
    version = migration.rollback(table, done.migration_id)
    docs = [table.read(v).select(F.lit(v).alias("version"), "p_partkey")
            for v in (done.version, version)]
    counts = docs[0].unionByName(docs[1]).groupBy("version").agg(
        F.count("p_partkey").alias("docs"))
    return migration.history(table).select(
        "migration_id", "action", "success", "version", "backup_version", "error",
        F.array_join(F.array_sort(F.transform(
            "changes", lambda c: F.concat(c["field"], F.lit(" "), c["change"]))), ",").alias("changes")).join(
        counts, "version")


@query("""
SELECT * FROM (VALUES ('c_custkey', 'long'), ('c_name', 'keyword'), ('c_nationkey', 'integer'),
  ('c_acctbal', 'double'), ('c_mktsegment', 'keyword')) AS v(path, type)
JOIN (SELECT unnest(['c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment']) AS path,
  unnest([count(c_custkey), count(c_name), count(c_nationkey), count(c_acctbal),
  count(c_mktsegment)]) AS docs FROM customer) USING (path)""")
def m8_mapping(t: Tables):
    """The mapping of a collection with the number of documents that fill each field."""
    rows = mapping_rows(t.customer.schema)
    counts = metrics(t.customer, {path: m.value_count(path) for path, _, _ in rows})
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(p).alias("path"), F.lit(kind).alias("type"), F.col(p).alias("docs"))
        for p, kind, _ in rows])).alias("f")).select("f.*")
