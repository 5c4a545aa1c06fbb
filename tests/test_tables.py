import pytest
from pyspark.sql import functions as F

from docquarry.plans import migration as g
from docquarry.sources.schema import Field
from docquarry.sources.snapshots import SnapshotTable
from docquarry.streaming import upserts as u


def docs(spark, *rows):
    return spark.createDataFrame(rows, "_id string, name string, age int")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def people(spark, tmp_path):
    return SnapshotTable.create(docs(spark, ("1", "a", 1), ("2", "b", 2), ("3", "c", 3)),
                                str(tmp_path / "people"), buckets=8)


BASE = {"name": Field("keyword"), "age": Field("integer")}


def changes(plan):
    return {(c.field, c.change, c.old_type, c.new_type) for c in plan.changes}


def plan(table, schema):
    now = table.read().schema
    return g.plan_changes(now, g.target_schema(now, schema, table.key))


# -- snapshots ---------------------------------------------------------------------
def test_versions_stay_readable(people, spark):
    people.upsert(docs(spark, ("2", "B", 20), ("4", "d", 4)))
    people.delete(spark.createDataFrame([("1",), ("9",)], "_id string"))
    assert rows(people.read()) == [("2", "B", 20), ("3", "c", 3), ("4", "d", 4)]
    assert rows(people.read(1)) == [("1", "a", 1), ("2", "b", 2), ("3", "c", 3)]
    assert people.commit().version == 3 and people.commit().parent == 2
    with pytest.raises(LookupError):
        people.read(9)


def test_only_touched_buckets_are_rewritten(people, spark):
    before = set(people.commit().folders)
    people.upsert(docs(spark, ("2", "B", 20)))
    assert len(before - set(people.commit().folders)) == 1


def test_mixed_batch(people, spark):
    ops = spark.createDataFrame([(1, "index", "2", "x", 1), (2, "delete", "2", None, None),
                                 (3, "index", "5", "y", 5)], "seq int, op string, _id string, name string, age int")
    people.apply(ops)
    assert rows(people.read()) == [("1", "a", 1), ("3", "c", 3), ("5", "y", 5)]


def test_lookup_reads_one_bucket(people):
    one = people.get(["2"])
    assert rows(one) == [("2", "b", 2)] and len(one.inputFiles()) == 1
    assert people.get(["9"]).count() == 0


def test_stored_updates(people, spark):
    people.update_where(F.col("age") >= 2, {"name": F.upper("name")})
    people.delete_where(F.col("age") == 1)
    people.merge(spark.createDataFrame([("3", None, 30)], "_id string, name string, age int"))
    assert rows(people.read()) == [("2", "B", 2), ("3", "C", 30)]


def test_a_collection_can_become_empty(people, spark):
    people.delete(people.read().select("_id"))
    assert people.read().count() == 0 and people.read().columns == ["_id", "name", "age"]
    people.upsert(docs(spark, ("9", "z", 9)))
    assert rows(people.read()) == [("9", "z", 9)]


def test_generated_ids_land_in_their_bucket(people, spark):
    people.upsert(docs(spark, *[(None, f"n{i}", i) for i in range(20)]))
    found = people.read().where("name like 'n%'")
    assert found.count() == 20 and found.where("_id is null").count() == 0
    people.delete(found.select("_id"))
    assert people.read().count() == 3


def test_a_failed_write_is_invisible(people, spark):
    def broken(now):
        return now.withColumn("age", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception):
        people.rewrite(people.read().select("_id"), broken)
    assert people.commit().version == 1 and people.read().count() == 3


# -- migration ---------------------------------------------------------------------
def test_plans(people):
    added = plan(people, {**BASE, "description": Field("text")})
    assert changes(added) == {("description", "added", None, "text")} and not added.requires_rewrite
    modified = plan(people, {**BASE, "age": Field("long")})
    assert changes(modified) == {("age", "modified", "integer", "long")} and modified.requires_rewrite
    deleted = plan(people, {"name": Field("keyword")})
    assert changes(deleted) == {("age", "deleted", "integer", None)} and deleted.requires_rewrite
    assert changes(plan(people, BASE)) == set()
    multi = plan(people, {**BASE, "name": Field("keyword", fields={"raw": Field("keyword")})})
    assert changes(multi) == {("name", "modified", "keyword", "keyword")}


def test_plan_sees_sub_properties(spark):
    old = {"o": Field("object", properties={"a": Field("integer")})}
    new = {"o": Field("object", properties={"a": Field("long")})}
    from docquarry.sources.schema import struct_type
    assert g.plan_changes(struct_type(old), struct_type(old)).changes == ()
    assert g.plan_changes(struct_type(old), struct_type(new)).named("modified") == ["o"]


def test_dry_run_writes_nothing(people):
    got = g.dry_run(people, {"name": Field("integer"), "note": Field("text")})
    assert {tuple(r) for r in got.collect()} == {
        ("name", "modified", "keyword", "integer", 3, 3), ("note", "added", None, "text", 0, 0),
        ("age", "deleted", "integer", None, 3, 0)}
    assert g.dry_run(people, BASE).collect() == []
    assert people.commit().version == 1 and g.history(people).count() == 0


def test_added_fields_keep_the_files(people):
    folders = people.commit().folders
    done = g.migrate(people, {**BASE, "description": Field("text")})
    assert people.commit().folders == folders and done.version == 2
    assert rows(people.read())[0] == ("1", "a", 1, None)


def test_rewrite_and_rollback_restore_the_rows(people):
    before = rows(people.read())
    done = g.migrate(people, {"name": Field("text"), "age": Field("long"), "n": Field("keyword", default="x")}, backup=True)
    assert rows(people.read())[0] == ("1", "a", 1, "x")
    assert dict(people.read().dtypes)["age"] == "bigint"
    g.rollback(people, done.migration_id)
    assert rows(people.read()) == before and dict(people.read().dtypes)["age"] == "int"
    with pytest.raises(g.MigrationError, match="already"):
        g.rollback(people, done.migration_id)
    assert [(h.migration_id, h.action, h.success) for h in g.history(people).collect()] == [
        ("m1", "rollback", True), ("m1", "migrate", True)]


def test_a_failed_migration_changes_nothing(people):
    before = rows(people.read())
    with pytest.raises(g.MigrationError, match="name"):
        g.migrate(people, {"name": Field("integer"), "age": Field("integer")}, backup=True)
    assert rows(people.read()) == before
    entry = g.history(people).first()
    assert not entry.success and "name" in entry.error
    with pytest.raises(g.MigrationError):
        g.rollback(people, "m1")
    lenient = g.migrate(people, {"name": Field("integer"), "age": Field("integer")}, malformed="null")
    assert lenient.migration_id == "m2" and [r.name for r in people.read().collect()] == [None] * 3


def test_losses_inside_objects_and_arrays_are_seen(spark, tmp_path):
    rows_ = [("1", ("5",), [("7",)], ["1", "2"]), ("2", ("x",), [("7",), ("y",)], ["1", "z"]), ("3", None, None, None)]
    table = SnapshotTable.create(spark.createDataFrame(
        rows_, "_id string, o struct<a:string>, l array<struct<b:string>>, t array<string>"), str(tmp_path / "t"))
    number = Field("integer")
    new = {"o": Field("object", properties={"a": number}), "l": Field("nested", properties={"b": number}),
           "t": Field("integer", many=True)}
    assert {(r.field, r.unconvertible) for r in g.dry_run(table, new).collect()} == {("o", 1), ("l", 1), ("t", 1)}
    with pytest.raises(g.MigrationError):
        g.migrate(table, new)
    g.migrate(table, new, malformed="null")
    got = {r._id: r for r in table.read().collect()}
    assert got["1"].o.a == 5 and got["2"].o.a is None and got["2"].t == [1, None]
    assert [e.b for e in got["2"].l] == [7, None] and got["3"].l is None


def test_a_scalar_can_become_many(people):
    assert plan(people, {**BASE, "name": Field("keyword", many=True)}).named("modified") == ["name"]
    g.migrate(people, {**BASE, "name": Field("keyword", many=True)})
    assert sorted(r.name for r in people.read().collect()) == [["a"], ["b"], ["c"]]


def test_rollback_needs_a_backup(people):
    done = g.migrate(people, {"name": Field("keyword")})
    with pytest.raises(g.MigrationError, match="backup"):
        g.rollback(people, done.migration_id)
    with pytest.raises(g.MigrationError, match="no completed"):
        g.rollback(people, "m7")


def test_history_is_newest_first_and_bounded(people):
    for i in range(3):
        g.migrate(people, {**BASE, **{f"f{j}": Field("long") for j in range(i + 1)}})
    assert [h.version for h in g.history(people).collect()] == [4, 3, 2]
    assert g.history(people, limit=2).count() == 2


# -- streaming ---------------------------------------------------------------------
OPS = "_id string, name string, age int, op string, seq int"


def run(spark, folder, batches, tmp_path, name="s", files=1):
    schema = spark.createDataFrame([], OPS).schema
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, OPS).coalesce(1).write.mode("append").parquet(str(folder))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(str(folder))
    table = u.open_table(stream, str(tmp_path / f"{name}-table"), "_id", "seq", "op", buckets=4)
    u.upsert_stream(stream, table, key="_id", seq="seq", op="op", every=None, name=name,
                    checkpoint=str(tmp_path / f"{name}-checkpoint")).awaitTermination()
    return table


BATCHES = [
    [("1", "a", 1, "index", 1), ("2", "b", 2, "index", 2), ("1", "a2", 3, "index", 5)],
    [("2", None, None, "delete", 4), ("3", "c", 3, "index", 3)],
    [("2", "b3", 9, "index", 7), ("1", "old", 0, "index", 2), ("3", None, None, "delete", 8)],
]
FINAL = [("1", "a2", 3), ("2", "b3", 9)]


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0)])
def test_stream_equals_one_batch_in_any_order(spark, tmp_path, order):
    table = run(spark, tmp_path / "in", [BATCHES[i] for i in order], tmp_path)
    assert rows(u.live(table)) == FINAL
    assert table.commit().version == 1  # nothing stored is rewritten
    for i, j in enumerate(order):  # a batch writes its own rows, collapsed by key
        written = spark.read.parquet(f"{table.root}/changes/stream=s/batch={i}")
        assert written.count() == len({r[0] for r in BATCHES[j]})
    assert u.compact(table) == 2 and u.compact(table) == 3
    assert rows(u.live(table)) == FINAL == rows(table.read().where("NOT _deleted").drop("_deleted", "_seq"))


def test_changes_after_a_compaction(spark, tmp_path):
    table = run(spark, tmp_path / "in", BATCHES[:2], tmp_path)
    u.compact(table)
    late = [("3", "late", 1, "index", 1), ("4", "d", 4, "index", 9), (None, "x", 1, "index", 1), (None, "y", 1, "index", 1)]
    got = rows(u.live(run(spark, tmp_path / "in", [*BATCHES[2:], late], tmp_path)).where("_id in ('1', '2', '3', '4')"))
    assert got == [*FINAL, ("4", "d", 4)]
    assert u.live(table).count() == 5 and u.live(table).select("_id").distinct().count() == 5


def test_stream_continues_and_repeats_nothing(spark, tmp_path):
    table = run(spark, tmp_path / "in", BATCHES[:2], tmp_path)
    version = table.commit().version
    run(spark, tmp_path / "in", [], tmp_path)
    assert table.commit().version == version
    assert rows(u.live(run(spark, tmp_path / "in", BATCHES[2:], tmp_path))) == FINAL


def test_a_repeated_batch_is_skipped(spark, tmp_path):
    table = run(spark, tmp_path / "in", BATCHES, tmp_path)
    version = table.commit().version
    # The same batches again, as after a crash between commit and checkpoint.
    schema = spark.createDataFrame([], OPS).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    u.upsert_stream(stream, table, key="_id", seq="seq", op="op", every=None, name="s",
                    checkpoint=str(tmp_path / "other")).awaitTermination()
    assert table.commit().version == version and rows(u.live(table)) == FINAL


# -- refusals ------------------------------------------------------------------------
def test_repeated_keys_need_an_order(spark):
    from docquarry.operators import mutate
    target = spark.createDataFrame([("1", "a")], "_id string, name string")
    twice = spark.createDataFrame([("2", "b"), ("2", "c")], "_id string, name string")
    with pytest.raises(Exception, match="given twice"):
        mutate.upsert(target, twice).collect()
    ordered = twice.withColumn("n", F.length("name") + F.ascii("name"))
    assert rows(mutate.upsert(target, ordered, seq="n")) == [("1", "a"), ("2", "c")]
    loose = spark.createDataFrame([(None, "x"), (None, "y"), (None, "y")], "_id string, name string")
    got = mutate.upsert(target, loose)
    assert got.count() == 4 and got.select("_id").distinct().count() == 4


def test_the_key_cannot_be_updated(people, spark):
    from docquarry.operators import mutate
    with pytest.raises(ValueError, match="key"):
        people.update_where(F.col("_id") == "1", {"_id": "2"})
    with pytest.raises(ValueError, match="key"):
        mutate.update_by_query(people.read(), F.lit(True), {"_id": "2"})


def test_merging_into_missing_documents_is_an_error(people, spark):
    patch = spark.createDataFrame([("1", "changed"), ("nobody", "x")], "_id string, name string")
    version = people.commit().version
    with pytest.raises(LookupError, match="nobody"):
        people.merge(patch)
    assert people.commit().version == version
    people.merge(patch, missing="skip")
    assert people.get(["1"]).first().name == "changed"


def test_last_per_key_keeps_one_row_for_equal_order(spark):
    from docquarry.operators.mutate import last_per_key
    ops = spark.createDataFrame([("1", "a", 1), ("1", "b", 1), ("1", "b", 1), ("2", "c", 0), (None, "d", 1), (None, "d", 1)],
                                "_id string, name string, seq int")
    got = sorted((tuple(r) for r in last_per_key(ops, "_id", "seq").collect()), key=repr)
    assert got == sorted([("1", "b", 1), ("2", "c", 0), (None, "d", 1), (None, "d", 1)], key=repr)
