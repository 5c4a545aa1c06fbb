import random

import pytest
from pyspark.sql import functions as F

from conftest import ids, optimized
from docquarry.functions.predicates import Fields
from docquarry.operators import constraints as c, mutate as mu
from docquarry.sources.schema import Field, load_json, mapping, mapping_rows, struct_type, typed_load


def table(spark, *data):
    return spark.createDataFrame(data, "_id string, name string, n int")


def as_dict(df):
    return {r["_id"]: (r["name"], r["n"]) for r in df.collect()}


def test_upsert_replaces_whole_documents(spark):
    now = table(spark, ("1", "a", 1), ("2", "b", 2))
    new = spark.createDataFrame([("2", "B"), ("3", "C")], "_id string, name string")
    assert as_dict(mu.upsert(now, new)) == {"1": ("a", 1), "2": ("B", None), "3": ("C", None)}
    assert mu.upsert(now, new).columns == now.columns


def test_upsert_is_idempotent(spark):
    now, new = table(spark, ("1", "a", 1)), table(spark, ("1", "z", 9), ("2", "y", 8))
    once = mu.upsert(now, new)
    assert as_dict(mu.upsert(once, new)) == as_dict(once)


def test_upsert_gives_ids_and_orders_repeats(spark):
    now = table(spark, ("1", "a", 1))
    new = spark.createDataFrame([(None, "x", 1, 1), ("1", "old", 2, 1), ("1", "new", 3, 2)],
                                "_id string, name string, n int, seq int")
    got = mu.upsert(now, new.where("_id is not null"), seq="seq")
    assert as_dict(got) == {"1": ("new", 3)}
    created = mu.upsert(now, new.where("_id is null").drop("seq"))
    assert created.where("_id is null").count() == 0 and created.count() == 2


def test_upsert_checks_fields(spark):
    now = table(spark, ("1", "a", 1))
    new = spark.createDataFrame([("1", True)], "_id string, extra boolean")
    with pytest.raises(ValueError):
        mu.upsert(now, new)
    assert mu.upsert(now, new, allow_new=True).columns == ["_id", "name", "n", "extra"]


def test_delete_by_ids(spark):
    now = table(spark, ("1", "a", 1), ("2", "b", 2), (None, "c", 3))
    assert len(mu.delete_by_ids(now, ["1", "9"]).collect()) == 2
    listed = spark.createDataFrame([("1",), ("1",)], "_id string")
    assert len(mu.delete_by_ids(now, listed).collect()) == 2


def simulate(start, ops):
    """One operation after the other, on a dict."""
    docs, report = dict(start), []
    for seq, op, key, name, n in sorted(ops):
        if op == "index":
            result = "updated" if key in docs else "created"
            docs[key] = (name, n)
        elif op == "delete":
            result = "deleted" if key in docs else "not_found"
            docs.pop(key, None)
        else:
            result = None
        report.append((seq, op, key, result))
    return docs, report


def test_mixed_batches_equal_a_simulation(spark):
    rng = random.Random(2)
    start = [(str(i), f"old{i}", i) for i in range(20)]
    # One key holds a third of all operations.
    ops = [(seq, rng.choice(["index", "index", "delete", "merge"]),
            "7" if rng.random() < 0.34 else str(rng.randint(0, 40)), f"new{seq}", seq)
           for seq in rng.sample(range(10_000), 700)]
    docs, report = simulate({k: (a, b) for k, a, b in start}, ops)
    now = table(spark, *start)
    batch = spark.createDataFrame(ops, "seq int, op string, _id string, name string, n int").repartition(5)
    assert as_dict(mu.apply_ops(now, batch)) == docs
    found = mu.bulk_report(now, batch)
    assert sorted((r.seq, r.op, r._id, r.result) for r in found.collect()) == report
    assert {(r.result, r.status) for r in found.collect()} <= {
        ("created", 201), ("updated", 200), ("deleted", 200), ("not_found", 404), (None, 400)}
    assert tuple(mu.bulk_summary(found).first()) == (700, True)
    fine = mu.bulk_report(now, batch.where("op <> 'merge'"))
    assert mu.bulk_summary(fine).first().errors is False


def test_last_operation_is_found_before_the_shuffle(spark):
    batch = spark.range(1000).select((F.col("id") % 2).alias("_id"), F.col("id").alias("seq"),
                                     F.lit("index").alias("op"))
    plan = mu.last_per_key(batch, "_id", "seq")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_max")


@pytest.fixture
def ferries(spark):
    return spark.createDataFrame([
        ("f1", "Aurora", 3.2, ["car", "foot"], ("Leith", None), [("Lerwick", 12), ("Kirkwall", 7)]),
        ("f2", "Borealis", 3.2, [], None, []),
        ("f3", "Cumulus", None, None, ("Oban", "p4"), [("Craignure", 1)])],
        "_id string, ship string, draught double, decks array<string>, home struct<port:string,pier:string>, "
        "calls array<struct<port:string,hours:int>>")


def test_update_by_query(ferries):
    q = Fields(ferries)
    deep = q.match_each({"draught": 3.2, "decks": "car"})
    got = mu.update_by_query(ferries, deep, {
        "draught": F.col("draught") * 2, "ship": F.concat("ship", F.lit(" II")), "decks": None,
        "calls": [{"port": "Stromness"}, {"hours": 2, "port": "Ullapool"}]})
    rows = {r._id: r for r in got.collect()}
    assert (rows["f1"].ship, rows["f1"].draught, rows["f1"].decks) == ("Aurora II", 6.4, None)
    assert [tuple(c) for c in rows["f1"].calls] == [("Stromness", None), ("Ullapool", 2)]
    before = {r._id: r for r in ferries.collect()}
    assert rows["f2"] == before["f2"] and rows["f3"] == before["f3"]
    assert got.schema.fieldNames() == ferries.columns


def test_update_sets_members_of_objects(ferries):
    q = Fields(ferries)
    got = mu.update_by_query(ferries, q.exists("home"), {"home": {"pier": "p9"}, "home.port": F.upper("home.port")})
    rows = {r._id: r.home for r in got.collect()}
    assert tuple(rows["f1"]) == ("LEITH", "p9") and tuple(rows["f3"]) == ("OBAN", "p9") and rows["f2"] is None
    for missing in ({"home": {"berth": 1}}, {"berth": 1}):
        with pytest.raises(ValueError):
            mu.update_by_query(ferries, q.exists("ship"), missing)


def test_delete_by_query_keeps_undecided_rows(spark):
    now = table(spark, ("1", "a", 1), ("2", "b", None))
    assert ids(mu.delete_by_query(now, Fields(now).term("n", 1))) == ["2"]


def test_merge_fields(ferries, spark):
    """A patch without an order fills in what it has; later ones win field by field."""
    patch = spark.createDataFrame([
        ("f3", 4.5, None, 10), ("f3", None, ("Mallaig", None), 30), ("f3", 4.0, ("Tobermory", "p1"), 20), ("f8", 1.0, None, 1)],
        "_id string, draught double, home struct<port:string,pier:string>, seq int")
    got = {r._id: r for r in mu.merge_fields(ferries, patch, seq="seq").collect()}
    assert set(got) == {"f1", "f2", "f3"}
    assert got["f3"].draught == 4.0 and got["f3"].home.port == "Mallaig" and got["f3"].ship == "Cumulus"
    assert got["f1"].draught == 3.2 and got["f2"].home is None
    assert ids(mu.unmatched(ferries, patch)) == ["f8"]


# -- constraints ------------------------------------------------------------------
RULES = {
    "status": Field("keyword", required=True, validate=lambda col: col.isin("active", "inactive", "pending")),
    "email": Field("keyword", validate=lambda col: col.rlike(r"^[^@]+@[^@]+\.[^@]+$")),
    "owner": Field("object", properties={"name": Field("keyword", required=True)}),
    "items": Field("nested", properties={
        "sku": Field("keyword", required=True), "n": Field("integer", validate=lambda col: col > 0)}),
}


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame([
        ("ok", "active", "a@b.c", ("x",), [("s", 1)]),
        ("bad", "unknown", "nope", (None,), [("s", 1), (None, 0)]),
        ("none", None, None, None, None),
        ("hole", "pending", None, ("x",), [None, ("s", None)]),
    ], "_id string, status string, email string, owner struct<name:string>, items array<struct<sku:string,n:int>>")


def test_violations(products):
    got = sorted(map(tuple, c.violations(products, RULES).collect()))
    assert got == [
        ("bad", "email", "validate"), ("bad", "items.n", "validate"), ("bad", "items.sku", "required"),
        ("bad", "owner.name", "required"), ("bad", "status", "validate"), ("none", "status", "required")]
    assert ids(c.valid(products, RULES)) == ["hole", "ok"]
    bad = {r._id: len(r.violations) for r in c.rejected(products, RULES).collect()}
    assert bad == {"bad": 5, "none": 1}
    assert c.violations(products, {}).count() == 0
    assert "Exchange" not in c.violations(products, RULES)._jdf.queryExecution().executedPlan().toString()


def test_validate_with_a_pandas_udf(products):
    import pandas as pd

    @F.pandas_udf("boolean")
    def short(values: pd.Series) -> pd.Series:
        return values.str.len() < 7

    got = c.violations(products, {"status": Field("keyword", validate=short)})
    assert ids(got) == ["bad", "hole"]


def test_missing_column_breaks_required(products):
    assert c.violations(products, {"price": Field("double", required=True)}).count() == 4


def test_defaults(spark):
    df = spark.createDataFrame([("1", None), ("2", 5)], "_id string, n int")
    got = c.with_defaults(df, {"n": 7, "at": F.current_timestamp, "tag": F.concat(F.lit("t"), "_id")})
    rows = got.orderBy("_id").collect()
    assert [r.n for r in rows] == [7, 5] and rows[0].tag == "t1" and rows[0].at is not None


# -- typed load -------------------------------------------------------------------
def test_typed_load(spark):
    raw = spark.createDataFrame([
        ("1", "10.7", "YES", "2024-01-02", "40.5, -73", ["A", None], "abcdef", "x"),
        ("2", "oops", None, "bad", "nowhere", None, "abc", "y"),
    ], "_id string, n string, flag string, day string, place string, tags array<string>, code string, junk string")
    schema = {
        "n": Field("integer", ignore_malformed=True),
        "flag": Field("keyword", normalizer="lowercase", null_value="NULL"),
        "day": Field("date", format="yyyy-MM-dd", ignore_malformed=True),
        "place": Field("geo_point", ignore_malformed=True),
        "tags": Field("keyword", many=True, normalizer="lowercase"),
        "code": Field("keyword", ignore_above=4, copy_to=("all",)),
        "all": Field("text"),
        "where": Field("alias", path="place"),
        "made": Field("long", default=5),
    }
    got = typed_load(raw, schema)
    assert got.columns == ["_id", *schema]
    one, two = got.orderBy("_id").collect()
    assert (one.n, one.flag, str(one.day), one.tags, one.code, one.made) == (
        10, "yes", "2024-01-02 00:00:00", ["a", None], None, 5)
    assert one.place.asDict() == {"lat": 40.5, "lon": -73.0} == one["where"].asDict()
    assert (two.n, two.flag, two.day, two.place, two.code, two["all"]) == (None, "NULL", None, None, "abc", "abc")
    assert Fields(got).field("all").analyzer is not None
    assert got.where(Fields(got).geo_distance("where", distance="10km", lat=40.5, lon=-73)).count() == 1


def test_malformed_values_fail_by_default(spark):
    raw = spark.createDataFrame([("1", "oops")], "_id string, n string")
    for kind in ("integer", "double", "date", "boolean"):
        with pytest.raises(Exception):
            typed_load(raw, {"n": Field(kind)}).collect()
    with pytest.raises(TypeError):
        typed_load(raw, {"n": Field("integer", coerce=False)})
    assert typed_load(raw, {"n": Field("integer", coerce=False, ignore_malformed=True)}).first().n is None


def test_every_field_type_has_a_spark_type():
    from docquarry.sources.schema import FIELD_TYPES
    extra = {"scaled_float": {"scaling_factor": 100}, "alias": {"path": "text"}}
    schema = {t: Field(t, **extra.get(t, {}), **({"properties": {"x": Field("long")}}
                                                 if t in ("object", "nested") else {}))
              for t in sorted(FIELD_TYPES)}
    assert len(schema) == 30
    types = {f.name: f.dataType.simpleString() for f in struct_type(schema)}
    assert types["byte"] == "tinyint" and types["half_float"] == "float" and types["alias"] == "string"
    assert types["date_range"] == "struct<gte:timestamp,lte:timestamp>"
    assert types["nested"] == "array<struct<x:bigint>>"
    assert types["completion"] == "struct<input:array<string>,weight:int>"
    with pytest.raises(ValueError):
        Field("invalid_type")


def test_load_json(spark):
    raw = spark.createDataFrame([
        ("1", '{"n": "3", "o": {"a": 1, "zz": 2}, "items": [{"k": "x", "v": 1.5}], "r": {"gte": 1, "lte": "9"}}'),
        ("2", "not json"),
    ], "_id string, doc string")
    schema = {
        "n": Field("long"), "o": Field("object", properties={"a": Field("integer"), "b": Field("keyword", default="d")}),
        "items": Field("nested", properties={"k": Field("keyword"), "v": Field("scaled_float", scaling_factor=10)}),
        "r": Field("integer_range"),
    }
    got = load_json(raw, "doc", schema)
    one, two = got.orderBy("_id").collect()
    assert one.n == 3 and one.o.asDict() == {"a": 1, "b": "d"} and one.r.asDict() == {"gte": 1, "lte": 9}
    assert [i.asDict() for i in one["items"]] == [{"k": "x", "v": 1.5}]
    assert two.n is None and two.o is None and two["items"] is None
    assert got.where(Fields(got).range("r", gte=9, lte=20)).count() == 1


def test_multi_fields_and_subfields(spark):
    raw = spark.createDataFrame([("1", "Hello World")], "_id string, t string")
    got = typed_load(raw, {"t": Field("text", fields={"raw": Field("keyword"), "words": Field("text", analyzer="whitespace")})})
    q = Fields(got)
    assert got.where(q.term("t.raw", "Hello World")).count() == 1
    assert got.where(q.term("t", "hello")).count() == 1
    assert got.where(q.term("t.words", "Hello")).count() == 1
    assert got.where(q.term("t.words", "hello")).count() == 0


def test_normalizers_apply_to_queries_too(spark):
    raw = spark.createDataFrame([("1", " New York "), ("2", "Rome")], "_id string, city string")
    from docquarry.functions.analysis import Normalizer
    for rule in ("lowercase_trim", Normalizer(trim=True, translate=("o", "0"))):
        got = typed_load(raw, {"city": Field("keyword", normalizer=rule)})
        q = Fields(got)
        for p in (q.term("city", "NEW YORK "), q.match("city", "New York"), q.terms("city", ["NEW YORK"]),
                  q.prefix("city", "NEW"), q.wildcard("city", "N?W*"), q.fuzzy("city", "NEW YORC")):
            assert ids(got.where(p)) == ["1"]


def test_field_boost_scales_scores(spark):
    from docquarry.operators import ranking as r
    raw = spark.createDataFrame([("1", "red fox"), ("2", "blue")], "_id string, t string")
    plain, boosted = (typed_load(raw, {"t": Field("text", boost=b)}) for b in (None, 3.0))
    score = lambda df: r.rank(df, must=[r.scored_match(Fields(df), "t", "red")]).first()._score
    assert score(boosted) == pytest.approx(3 * score(plain))


def test_composite_types_load_from_simple_values(spark):
    raw = spark.createDataFrame([("1", "abc", "question", None, "1,2"), ("2", None, None, None, None)],
                                "_id string, c string, j string, g string, x string")
    got = typed_load(raw, {"c": Field("completion"), "j": Field("join"),
                           "g": Field("geo_point", null_value="10,20"),
                           "x": Field("xy_point", null_value={"x": 0, "y": 9})}).orderBy("_id").collect()
    assert got[0].c.input == ["abc"] and got[0].j.name == "question"
    assert got[0].g.asDict() == {"lat": 10, "lon": 20} and got[0].x.asDict() == {"x": 1, "y": 2}
    assert got[1].c is None and got[1].x.asDict() == {"x": 0, "y": 9}


def test_a_single_object_loads_as_nested(spark):
    raw = spark.createDataFrame([("1", ("x",)), ("2", None)], "_id string, a struct<k:string>")
    got = typed_load(raw, {"a": Field("nested", properties={"k": Field("keyword")})}).orderBy("_id").collect()
    assert [len(got[0].a), got[1].a] == [1, None]


def test_mapping(people, spark):
    rows = {r.path: r.type for r in mapping(spark, people.schema).collect()}
    assert rows["description"] == "text" and rows["address"] == "nested"
    assert rows["address.street"] == "text" and rows["createdAt"] == "date" and rows["tags"] == "keyword"
    assert len(rows) == len(mapping_rows(people.schema)) == 10


def test_typed_load_is_one_projection(spark):
    raw = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    plan = optimized(typed_load(raw, {"c_name": Field("text"), "c_acctbal": Field("scaled_float", scaling_factor=10)}, key="c_custkey"))
    assert plan.count("Project") == 1 and "Aggregate" not in plan and "Join" not in plan
