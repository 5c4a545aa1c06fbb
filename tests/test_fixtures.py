"""Small models that use several operators: lighthouses, departments, sales, parcels, seeds."""

import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import ids
from docquarry.functions import metrics as m
from docquarry.functions.predicates import Fields, at_least, bool_
from docquarry.operators import constraints, mutate, relations
from docquarry.operators.buckets import DateHistogram, Level, nest
from docquarry.operators.matrix import matrix_stats
from docquarry.sources.schema import Field, struct_type, typed_load


def test_lighthouses_near_and_inside(spark):
    """Points on both sides of the date line, circles and boxes that cross it."""
    schema = {"_id": Field("keyword"), "light": Field("text"), "at": Field("geo_point")}
    lights = spark.createDataFrame([
        ("cook", "green harbour light", (-17.2, 179.6)), ("taveuni", "white cape light", (-16.9, -179.9)),
        ("savusavu", "red harbour light", (-16.8, 179.3)), ("apia", "white harbour light", (-13.8, -171.8)),
        ("lost", "unlit rock", None)], struct_type(schema))
    q = Fields(lights)
    near = q.geo_distance("at", distance="75km", lat=-17.0, lon=180.0)
    strait = q.geo_bounding_box("at", top_left={"lat": -16.85, "lon": 179.5}, bottom_right={"lat": -17.5, "lon": -179.5})
    assert ids(lights.where(near)) == ["cook", "taveuni"]
    assert ids(lights.where(q.geo_distance("at", distance="80km", lat=-17.0, lon=180.0))) == ["cook", "savusavu", "taveuni"]
    assert ids(lights.where(strait)) == ["cook", "taveuni"]
    assert ids(lights.where(q.bool(must=[q.match("light", "harbour")], must_not=[strait]))) == ["apia", "savusavu"]


def test_departments_and_employees(spark):
    departments = spark.createDataFrame([("d1", "Engineering"), ("d2", "Sales")], "_id string, name string")
    employees = spark.createDataFrame([("e1", "Ann Lee", "d1"), ("e2", "Bo Ray", "d2"), ("e3", "Cy Lee", "d1")],
                                      "_id string, name string, departmentId string")
    q, staff = Fields(departments), Fields(employees, text=["name"])
    assert ids(relations.has_parent(employees, departments, "departmentId", "_id",
                                    q.term("name", "Engineering"))) == ["e1", "e3"]
    assert ids(relations.has_child(departments, employees, "_id", "departmentId",
                                   staff.match("name", "ray"))) == ["d2"]


def test_sales(spark):
    sales = spark.createDataFrame([
        ("a", 10.0, 1, dt.datetime(2024, 1, 5)), ("b", 20.0, 2, dt.datetime(2024, 1, 9)),
        ("a", 60.0, 6, dt.datetime(2024, 3, 1))], "product string, amount double, quantity int, date timestamp")
    got = nest(sales, [Level("month", DateHistogram("date", "month", format="yyyy-MM"),
                             {"total": m.sum("amount"), "stats": m.extended_stats("amount")})]).collect()
    assert [(r.month_as_string, r.month_doc_count, r.total) for r in got] == [
        ("2024-01", 2, 30.0), ("2024-02", 0, None), ("2024-03", 1, 60.0)]
    assert got[0].stats.variance == 25 and got[0].stats.std_deviation_bounds.lower == 5
    pair = matrix_stats(sales, ["amount", "quantity"]).where("field <> other").first()
    assert pair.correlation == pytest.approx(1.0)


def test_parcels_arrive_in_batches(spark):
    """Generated and given ids, a repeat inside a batch, a column that the collection lacks."""
    columns = "_id string, depot string, grams bigint, fragile boolean"
    yard = spark.createDataFrame([("p7", "north", 1200, False), ("p8", "south", 80, True), ("p9", "south", 80, None)], columns)
    batch = spark.createDataFrame([("p8", "west", 95, True, 4), ("p8", "east", 90, False, 2), ("p20", None, 3, None, 1)],
                                  columns + ", scan int")
    now = mutate.upsert(yard, batch, seq="scan")
    assert {r["_id"]: (r.depot, r.grams, r.fragile) for r in now.collect()} == {
        "p7": ("north", 1200, False), "p8": ("west", 95, True), "p9": ("south", 80, None), "p20": (None, 3, None)}
    nameless = spark.createDataFrame([(None, "north", n, True) for n in range(4)], columns)
    grown = mutate.upsert(now, nameless)
    assert grown.count() == 8 and grown.select("_id").distinct().count() == 8
    assert ids(mutate.delete_by_ids(now, ["p9", "p7", "p9", "p1000"])) == ["p20", "p8"]
    with pytest.raises(ValueError, match="colour"):
        mutate.upsert(yard, nameless.withColumn("colour", F.lit("blue")))


def test_seed_catalogue(spark):
    """Required text, a checked code, objects, and a keyword form of a text field."""
    schema = {
        "variety": Field("text", required=True, fields={"exact": Field("keyword")}),
        "code": Field("keyword", validate=lambda c: c.rlike("^[A-Z]{2}-[0-9]{4}$")),
        "bed": Field("object", properties={"note": Field("text"), "row": Field("integer")}),
    }
    raw = spark.createDataFrame([
        ("s1", "Purple Podded Pea", "PE-0417", ("dry, sunny corner", "12")), ("s2", "   ", "PE-417", None),
        ("s3", None, None, ("shade", None)), ("s4", "pea, sugar", "TO-9000", ("sunny wall", "3.9"))],
        "_id string, variety string, code string, bed struct<note:string,row:string>")
    seeds = typed_load(raw, schema)
    q = Fields(seeds)
    assert ids(seeds.where(q.match("variety", "pea"))) == ["s1", "s4"]
    assert ids(seeds.where(q.match("variety", "sugr peas", operator="AND", fuzziness="AUTO"))) == ["s4"]
    assert ids(seeds.where(q.term("variety.exact", "Purple Podded Pea"))) == ["s1"]
    assert ids(seeds.where(q.match("bed.note", "sunny") & q.range("bed.row", lt=10))) == ["s4"]
    assert sorted((v._id, v.field, v.rule) for v in constraints.violations(seeds, schema).collect()) == [
        ("s2", "code", "validate"), ("s3", "variety", "required")]


LEAVES = st.sampled_from(["a", "b", "n"])
CLAUSES = st.lists(LEAVES, max_size=3)


@settings(max_examples=25, deadline=None)
@given(must=CLAUSES, flt=CLAUSES, should=CLAUSES, must_not=CLAUSES,
       minimum=st.one_of(st.none(), st.integers(0, 3)))
def test_bool_equals_two_valued_logic(spark, must, flt, should, must_not, minimum):
    values = [None, True, False]
    rows = [(i, a, b) for i, (a, b) in enumerate((a, b) for a in values for b in values)]
    df = spark.createDataFrame(rows, "i int, a boolean, b boolean")
    leaf = {"a": F.col("a"), "b": F.col("b"), "n": F.col("a").isNull()}
    truth = {"a": lambda r: bool(r[1]), "b": lambda r: bool(r[2]), "n": lambda r: r[1] is None}

    def expected(r):
        if not all(truth[c](r) for c in must + flt) or any(truth[c](r) for c in must_not):
            return False
        if not should:
            return True
        need = minimum if minimum is not None else (0 if must or flt else 1)
        return sum(truth[c](r) for c in should) >= need

    where = bool_([leaf[c] for c in must], [leaf[c] for c in flt], [leaf[c] for c in should],
                  [leaf[c] for c in must_not], minimum)
    assert ids(df.where(where), "i") == [r[0] for r in rows if expected(r)]


def test_at_least(spark):
    df = spark.createDataFrame([(1, True, None), (2, True, True), (3, None, False)], "i int, a boolean, b boolean")
    both = [F.col("a"), F.col("b")]
    assert [ids(df.where(at_least(both, n)), "i") for n in range(4)] == [[1, 2, 3], [1, 2], [2], []]
