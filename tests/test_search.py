import random

import pytest
from pyspark.sql import functions as F

from conftest import ids, plan_of
from docquarry.functions.predicates import Fields
from docquarry.operators import ranking as r, relations as rel, search as s


def test_goldens(users):
    assert [x.age for x in s.search(users, sort=["age"]).collect()] == [25, 30, 35]
    assert [x.age for x in s.search(users, sort=[s.SortBy("age", "desc")]).collect()] == [35, 30, 25]
    assert s.search(users, from_=1, size=1).count() == 1
    assert s.count(users, Fields(users).range("age", gte=30)).first()[0] == 2
    assert s.get(users, "2").first().username == "user2"
    assert s.get(users, "9").count() == 0


def test_page_size_defaults_to_ten(spark):
    df = spark.range(25).withColumnRenamed("id", "_id")
    assert [x[0] for x in s.search(df).collect()] == list(range(10))
    assert [x[0] for x in s.search(df, from_=20).collect()] == [20, 21, 22, 23, 24]


@pytest.fixture(scope="module")
def mixed(spark):
    return spark.createDataFrame([
        ("a", 2, [1, 5]), ("b", None, []), ("c", 1, None), ("d", 2, [3, None, 4]), ("e", 3, [2, 9, 4]),
    ], "_id string, n int, v array<int>")


def test_sort_missing(mixed):
    order = lambda *sort: [x[0] for x in s.search(mixed, sort=sort).collect()]
    assert order("n") == ["c", "a", "d", "e", "b"]
    assert order(s.SortBy("n", "desc")) == ["e", "a", "d", "c", "b"]
    assert order(s.SortBy("n", missing="_first")) == ["b", "c", "a", "d", "e"]
    assert order(s.SortBy("n", missing=2)) == ["c", "a", "b", "d", "e"]


@pytest.mark.parametrize("mode, order", [
    ("min", "aedbc"), ("max", "daebc"), ("sum", "adebc"), ("avg", "adebc"), ("median", "adebc")])
def test_sort_mode(mixed, mode, order):
    found = [x[0] for x in s.search(mixed, sort=[s.SortBy("v", mode=mode)]).collect()]
    assert found == list(order)


@pytest.mark.parametrize("rule", [
    s.SortBy("n"), s.SortBy("n", "desc"), s.SortBy("n", missing="_first"),
    s.SortBy("n", "desc", missing="_first")])
def test_paging_by_key_visits_every_row_once(mixed, rule):
    everything = [tuple(x) for x in s.search(mixed, sort=[rule], source=["n"]).collect()]
    seen, after = [], None
    while True:
        page = s.search(mixed, sort=[rule], size=2, after=after, source=["n"]).collect()
        if not page:
            break
        seen += [tuple(x) for x in page]
        after = [page[-1].n, page[-1]._id]
    assert seen == everything


def test_totals(spark):
    df = spark.range(50)
    total = lambda track: tuple(s.total_hits(df, F.col("id") < 30, track).first())
    assert total(True) == (30, "eq")
    assert total(10) == (10, "gte")
    assert total(30) == (30, "eq")
    assert total(31) == (30, "eq")
    assert total(200_000) == (30, "eq") and total(False) == (None, None)


def test_source_filter(users):
    get = lambda source: s.source_filter(users, source).schema
    assert get(False).fieldNames() == ["_id"]
    assert get(True) == users.schema
    assert get(["age"]).fieldNames() == ["_id", "age"]
    assert get({"includes": ["address.*"], "excludes": ["address.street"]})["address"].dataType.fieldNames() == ["city", "country"]
    assert get({"excludes": ["*e*"]}).fieldNames() == ["_id"]
    assert get(["address.city"]).fieldNames() == ["_id", "address"]
    row = s.source_filter(users, ["address.city"]).orderBy("_id").first()
    assert row.address.asDict() == {"city": "New York"}


def test_source_filter_keeps_null_objects_and_arrays(people):
    rows = {x._id: x.address for x in s.source_filter(people, ["address.city"]).collect()}
    assert rows["3"] is None
    assert [e.asDict() for e in rows["1"]] == [{"city": "New York"}]


def test_source_filter_prunes_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    page = s.search(orders, sort=["o_totalprice"], source=["o_orderstatus"], key="o_orderkey")
    plan = plan_of(page)
    assert "TakeOrderedAndProject" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in plan


def test_get_by_ids(users, spark):
    assert ids(s.get_by_ids(users, ["1", "3", "x"])) == ["1", "3"]
    listed = spark.createDataFrame([("1",), ("1",), ("2",), (None,)], "_id string")
    assert ids(s.get_by_ids(users, listed)) == ["1", "2"]


# -- ranking --------------------------------------------------------------------
@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([
        ("1", "red apple", 1), ("2", "red red pear and a lot of other words", 2), ("3", "green", 3),
        ("4", None, 4)], "_id string, t string, n int")


def test_scores(texts):
    q = Fields(texts, text=["t"])
    hits = r.rank(texts, must=[r.scored_match(q, "t", "red")]).collect()
    assert [h._id for h in hits] == ["1", "2"]
    import math
    idf, mean = math.log(1 + (3 - 2 + 0.5) / 2.5), 12 / 3
    one = idf * 1 * 2.2 / (1 + 1.2 * (0.25 + 0.75 * 2 / mean))
    assert hits[0]._score == pytest.approx(one)


def test_score_parts(texts):
    q = Fields(texts, text=["t"])
    scores = lambda **c: {h._id: round(h._score, 6) for h in r.score_all(texts, **c).collect()}
    assert scores() == {"1": 0.0, "2": 0.0, "3": 0.0, "4": 0.0}
    assert scores(must=[r.scored(q.range("n", gte=2), 3.0)]) == {"2": 3.0, "3": 3.0, "4": 3.0}
    assert scores(filter=[q.term("n", 1)], should=[r.scored(q.term("n", 9))]) == {"1": 0.0}
    base = scores(must=[r.scored_match(q, "t", "red apple")])
    assert base["1"] > base["2"]
    double = scores(must=[r.scored_match(q, "t", "red apple", boost=2.0)])
    assert double == {k: pytest.approx(2 * v, abs=1e-5) for k, v in base.items()}
    both = scores(should=[r.scored_match(q, "t", "red apple", operator="AND"), r.scored(q.term("n", 2))])
    assert both == {"1": base["1"], "2": 1.0}
    assert r.max_score(r.score_all(texts, must=[r.scored_match(q, "t", "red")])).first()[0] > 0


def test_statistics_are_one_subquery(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    q = Fields(docs, text=["text"])
    hits = r.rank(docs, must=[r.scored_match(q, "text", "the of and")], key="doc_id")
    hits.collect()
    final = plan_of(hits).split("Initial Plan")[0]
    assert "ReusedSubquery" in final
    assert "CartesianProduct" not in final and "NestedLoop" not in final


# -- relations --------------------------------------------------------------------
@pytest.fixture(scope="module")
def staff(spark):
    parents = spark.createDataFrame([("d1", "IT"), ("d2", "HR"), ("d3", "Ops")], "_id string, name string")
    children = spark.createDataFrame([
        ("e1", "d1", 5), ("e2", "d1", 1), ("e3", "d2", 1), ("e4", None, 9)],
        "_id string, dept string, level int")
    return parents, children


def test_has_child_and_has_parent(staff):
    parents, children = staff
    senior = Fields(children).range("level", gte=5)
    assert ids(rel.has_child(parents, children, "_id", "dept", senior)) == ["d1"]
    assert ids(rel.has_child(parents, children, "_id", "dept", senior, negate=True)) == ["d2", "d3"]
    it = Fields(parents).term("name", "IT")
    assert ids(rel.has_parent(children, parents, "dept", "_id", it)) == ["e1", "e2"]
    assert ids(rel.has_parent(children, parents, "dept", "_id", it, negate=True)) == ["e3", "e4"]
    assert ids(rel.terms_lookup(children, "dept", parents, "_id")) == ["e1", "e2", "e3"]


def test_relations_inside_one_collection(spark):
    docs = spark.createDataFrame([
        ("q1", "question", None, 1), ("q2", "question", None, 2), ("a1", "answer", "q1", 3)],
        "_id string, kind string, parent string, n int")
    questions, answers = (rel.relation_side(docs, "kind", k) for k in ("question", "answer"))
    assert ids(rel.has_child(questions, answers, "_id", "parent")) == ["q1"]
    assert ids(rel.has_parent(answers, questions, "parent", "_id", F.col("n") == 1)) == ["a1"]


def test_a_hot_parent_is_split(spark):
    """A third of the children share one parent: its partition is split, not run as one task."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000)
        children = spark.range(0, 200_000, 1, 8).select(F.col("id").alias("_id"), key.alias("p"))
        parents = spark.range(5000).select(F.col("id").alias("pk"), (F.col("id") % 2).alias("odd"))
        found = rel.has_parent(children, parents, "p", "pk", F.col("odd") == 1)
        expected = children.where(F.col("p") % 2 == 1).count()
        assert len(found.select("_id").collect()) == expected
        rows = found.select("_id")
        rows.collect()
        assert "skew=true" in plan_of(rows)
        # The many children of one parent are reduced before they are sent.
        plan = plan_of(rel.has_child(parents, children, "pk", "p"))
        assert plan.index("LeftSemi") < plan.index("HashAggregate")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("order,missing", [("asc", "_last"), ("desc", "_first"), ("asc", "_first"), ("desc", "_last")])
def test_deep_pages_equal_ranked_pages(spark, monkeypatch, order, missing):
    rng = random.Random(7)
    rows = [(rng.randrange(40), rng.choice([None, *range(6)]), rng.choice(["x", "y", None])) for _ in range(700)]
    df = spark.createDataFrame(rows, "_id int, n int, w string").repartition(6)
    sort = [s.SortBy("n", order, missing), "w"]
    where = F.col("_id") != 7
    ranked = [tuple(r) for r in s.search(df, where, sort, size=1000).collect()]
    monkeypatch.setattr(s, "DEEP", 5)
    for from_ in (6, 123, 400, len(ranked) - 3, len(ranked), 5000):
        got = [tuple(r) for r in s.search(df, where, sort, from_=from_, size=12).collect()]
        assert got == ranked[from_:from_ + 12], from_


def test_a_deep_page_ranks_no_more_than_itself(spark):
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    plan = plan_of(s.search(lines, sort=["l_shipdate", "l_extendedprice", "l_linenumber"], from_=50_000, size=10, key="l_orderkey"))
    limit = int(plan.split("TakeOrderedAndProject(limit=")[1].split(",")[0])
    assert limit < 20 and "SinglePartition" not in plan
