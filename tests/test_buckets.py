import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import optimized, plan_of
from docquarry.functions import metrics as m
from docquarry.functions.predicates import Fields
from docquarry.operators import buckets
from docquarry.operators.buckets import (
    DateHistogram, Level, Ranges, Terms, aggregations, date_histogram, metrics, nest,
    range_buckets, terms)
from docquarry.operators.matrix import matrix_stats


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_goldens(users, people):
    assert rows(terms(users, "age"), "key", "doc_count") == [(25, 1), (30, 1), (35, 1)]
    by_city = terms(users, "address.city.keyword", sub={"avg_age": m.avg("age")})
    assert rows(by_city, "key", "avg_age") == [("Chicago", 35), ("Los Angeles", 30), ("New York", 25)]
    assert tuple(metrics(people, {"a": m.avg("age"), "b": m.min("age"), "c": m.max("age")}).first()) == (30, 25, 35)
    assert terms(people, "tags").count() == 6
    months = date_histogram(people, "createdAt", calendar_interval="month", format="yyyy-MM")
    assert rows(months, "key_as_string", "doc_count") == [("2024-01", 2), ("2024-02", 1)]
    ages = range_buckets(people, "age", [{"to": 30}, {"from": 30, "to": 40}, {"from": 40}])
    assert rows(ages, "key", "doc_count") == [("*-30", 1), ("30-40", 2), ("40-*", 0)]


def test_extended_stats(spark):
    df = spark.createDataFrame([(x,) for x in (1.0, 2.0, 3.0, 4.0, None)], "x double")
    s = metrics(df, {"s": m.extended_stats("x")}).first().s
    assert (s.count_ if hasattr(s, "count_") else s["count"]) == 4
    assert (s.avg, s["sum"], s.sum_of_squares, s.variance) == (2.5, 10, 30, 1.25)
    assert s.std_deviation_bounds.upper == pytest.approx(2.5 + 2 * 1.25 ** 0.5)
    assert metrics(df, {"s": m.stats("x", missing=10)}).first().s.avg == 4.0


def test_metrics_over_many_values(spark):
    df = spark.createDataFrame([([1, 5],), ([],), (None,), ([2, None],)], "v array<int>")
    got = metrics(df, {"n": m.value_count("v", many=True), "s": m.sum("v", many=True),
                       "a": m.avg("v", many=True), "lo": m.min("v", many=True),
                       "hi": m.max("v", many=True)}).first()
    assert tuple(got) == (3, 8.0, pytest.approx(8 / 3), 1, 5)


def test_multi_metric_is_a_struct(users):
    got = terms(users, "address.country", sub={"age": m.multi(avg=m.avg("age"), max=m.max("age"))})
    assert rows(got, "key", "doc_count") == [("USA", 3)]
    assert got.first().age.asDict() == {"avg": 30.0, "max": 35}


def test_terms_options(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 2), ("b", 9), (None, 3), ("c", 1), ("c", 1), ("c", 1)], "k string, v int")
    assert rows(terms(df, "k"), "key", "doc_count") == [("c", 3), ("a", 2), ("b", 1)]
    assert rows(terms(df, "k", size=1), "key") == [("c",)]
    assert rows(terms(df, "k", missing="z"), "key") == [("c",), ("a",), ("b",), ("z",)]
    assert rows(terms(df, "k", min_doc_count=2), "key") == [("c",), ("a",)]
    assert rows(terms(df, "k", include="[ab]", order={"_key": "desc"}), "key") == [("b",), ("a",)]
    assert rows(terms(df, "k", exclude=["a"]), "key") == [("c",), ("b",)]
    by_metric = terms(df, "k", order={"top": "desc"}, sub={"top": m.max("v")})
    assert rows(by_metric, "key", "top") == [("b", 9), ("a", 2), ("c", 1)]
    by_member = terms(df, "k", order={"v.min": "desc"}, sub={"v": m.multi(min=m.min("v"))})
    assert rows(by_member, "key") == [("b",), ("a",), ("c",)]
    empty = terms(df, "k", where=F.col("v") == 9, min_doc_count=0)
    assert rows(empty, "key", "doc_count") == [("b", 1), ("a", 0), ("c", 0)]


def test_array_terms_count_a_document_once(spark):
    df = spark.createDataFrame([(["x", "x", "y"],), (["x"],), ([],), (None,), ([None],)], "t array<string>")
    assert rows(terms(df, "t"), "key", "doc_count") == [("x", 2), ("y", 1)]
    assert rows(terms(df, "t", missing="none"), "key", "doc_count") == [("none", 3), ("x", 2), ("y", 1)]


def at(*parts):
    return dt.datetime(*parts)


def test_date_histogram_fills_gaps(spark):
    df = spark.createDataFrame([(at(2024, 1, 31, 5),), (at(2024, 4, 1),), (at(2024, 4, 30, 23),), (None,)], "ts timestamp")
    months = date_histogram(df, "ts", calendar_interval="month")
    assert rows(months, "key", "doc_count") == [
        (at(2024, 1, 1), 1), (at(2024, 2, 1), 0), (at(2024, 3, 1), 0), (at(2024, 4, 1), 2)]
    assert date_histogram(df, "ts", calendar_interval="month", min_doc_count=1).count() == 2
    assert date_histogram(df, "ts", calendar_interval="1d").count() == 91
    assert date_histogram(df, "ts", fixed_interval="12h").count() == 182
    # A gap much longer than one array of empty buckets.
    minutes = date_histogram(df, "ts", fixed_interval="1m")
    assert minutes.count() == 130_681 and minutes.where("doc_count > 0").count() == 3
    weeks = date_histogram(df, "ts", calendar_interval="week").orderBy("key").first().key
    assert weeks == at(2024, 1, 29)


def test_date_histogram_without_rows(spark):
    df = spark.createDataFrame([(None,)], "ts timestamp")
    assert date_histogram(df, "ts", calendar_interval="day").collect() == []


def test_date_histogram_zone_and_offset(spark):
    df = spark.createDataFrame([(at(2024, 3, 9, 12),), (at(2024, 3, 10, 12),), (at(2024, 3, 11, 12),),
                                (at(2024, 3, 12, 3, 59),)], "ts timestamp")
    days = date_histogram(df, "ts", calendar_interval="day", time_zone="America/New_York",
                          format="yyyy-MM-dd HH:mm")
    # The clock change: one day is 23 hours long.
    assert rows(days, "key", "key_as_string", "doc_count") == [
        (at(2024, 3, 9, 5), "2024-03-09 00:00", 1), (at(2024, 3, 10, 5), "2024-03-10 00:00", 1),
        (at(2024, 3, 11, 4), "2024-03-11 00:00", 2)]
    shifted = date_histogram(df, "ts", calendar_interval="day", offset="+6h", min_doc_count=1)
    assert rows(shifted.orderBy("key"), "key", "doc_count") == [
        (at(2024, 3, 9, 6), 1), (at(2024, 3, 10, 6), 1), (at(2024, 3, 11, 6), 2)]
    quarter = date_histogram(df, "ts", fixed_interval="90m", offset="-30m", min_doc_count=1)
    assert (at(2024, 3, 9, 11, 30)) in [r.key for r in quarter.collect()]
    half = date_histogram(df, "ts", calendar_interval="hour", time_zone="Asia/Kolkata", min_doc_count=1)
    assert (at(2024, 3, 9, 11, 30)) in [r.key for r in half.collect()]


def test_interval_errors(people):
    for bad in ({}, {"calendar_interval": "day", "fixed_interval": "1d"},
                {"calendar_interval": "eon"}, {"fixed_interval": "1 parsec"}, {"fixed_interval": "0s"}):
        with pytest.raises(ValueError):
            date_histogram(people, "createdAt", **bad)


RANGES = [{"to": 3}, {"from": 2, "to": 6, "key": "mid"}, {"from": 9}]


def test_ranges(spark):
    df = spark.createDataFrame([(float(i),) for i in range(8)] + [(None,)], "x double")
    plain = rows(range_buckets(df, "x", RANGES), "key", "from", "to", "doc_count")
    assert plain == [("*-3", None, 3, 3), ("mid", 2, 6, 4), ("9-*", 9, None, 0)]
    sub = range_buckets(df, "x", RANGES, sub={"top": m.max("x")})
    assert sorted(rows(sub, "key", "doc_count", "top"), key=str) == sorted(
        [("*-3", 3, 2), ("mid", 4, 5), ("9-*", 0, None)], key=str)
    apart = range_buckets(df, "x", [{"to": 2}, {"from": 2, "to": 4}], sub={"top": m.max("x")})
    assert sorted(rows(apart, "key", "doc_count", "top")) == [("*-2", 2, 1), ("2-4", 2, 3)]
    assert "Generate" not in optimized(range_buckets(df, "x", [{"to": 2}, {"from": 2}],
                                                     sub={"n": m.max("x")}).where("key = 'x'")).split("Aggregate")[-1]
    none = range_buckets(df.where("x > 100"), "x", RANGES, sub={"top": m.max("x")})
    assert [r.doc_count for r in none.collect()] == [0, 0, 0]


def test_range_over_many_values(spark):
    df = spark.createDataFrame([([1, 4],), ([4, 5],), (None,)], "v array<int>")
    got = range_buckets(df, "v", RANGES, sub={"n": F.count("*")})
    assert sorted(rows(got, "key", "doc_count")) == [("*-3", 1), ("9-*", 0), ("mid", 2)]


def test_names_are_given_once(people):
    with pytest.raises(ValueError):
        nest(people, [Level("a", Terms("age")), Level("a", Terms("name"))])
    with pytest.raises(ValueError):
        nest(people, [Level("a", Terms("age"), {"a_doc_count": m.avg("age")})])


def brute(data, keys_of, sizes):
    """Nested terms counts, top by count then key, on plain rows."""
    if not keys_of:
        return [()]
    groups = defaultdict(list)
    for row in data:
        for key in keys_of[0](row):
            groups[key].append(row)
    out = []
    for key in sorted(groups, key=lambda k: (-len(groups[k]), k))[:sizes[0]]:
        for rest in brute(groups[key], keys_of[1:], sizes[1:]):
            out.append((key, len(groups[key]), *rest))
        if not groups[key]:
            out.append((key, 0))
    return out


@pytest.mark.parametrize("sizes", [(2, 3, 2), (10_001, 2, 2), (3, 20_000, 1)])
def test_nested_terms_equal_brute_force(spark, sizes):
    """Broadcast outer levels, and outer levels joined afterwards, give the same rows."""
    rng = random.Random(11)
    data = [(rng.choice("aaabbc"), [rng.choice("xyz") for _ in range(rng.randint(1, 3))], rng.randint(0, 4))
            for _ in range(600)]
    df = spark.createDataFrame(data, "a string, t array<string>, n int")
    got = nest(df, [Level("l1", Terms("a", size=sizes[0])), Level("l2", Terms("t", size=sizes[1])),
                    Level("l3", Terms("n", size=sizes[2]))])
    expected = brute(data, [lambda r: [r[0]], lambda r: set(r[1]), lambda r: [r[2]]], sizes)
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_empty_inner_levels_keep_the_outer_bucket(spark):
    df = spark.createDataFrame([("a", None, at(2024, 1, 1)), ("b", "x", None), ("b", "x", at(2024, 1, 3)),
                                ("b", "y", at(2024, 1, 1))], "k string, s string, ts timestamp")
    got = nest(df, [Level("k", Terms("k")), Level("s", Terms("s", include="x"), {"n": F.count("*")})])
    assert sorted(rows(got, "k", "k_doc_count", "s", "s_doc_count", "n")) == [
        ("a", 1, None, None, None), ("b", 3, "x", 2, 2)]
    days = nest(df, [Level("k", Terms("k")), Level("d", DateHistogram("ts", "day"))])
    assert sorted(rows(days, "k", "d", "d_doc_count")) == [
        ("a", at(2024, 1, 1), 1), ("b", at(2024, 1, 1), 1), ("b", at(2024, 1, 2), 0), ("b", at(2024, 1, 3), 1)]
    deep = nest(df, [Level("k", Terms("k")), Level("s", Terms("s", include="none")),
                     Level("d", DateHistogram("ts", "day"))])
    assert sorted(rows(deep, "k", "s", "d")) == [("a", None, None), ("b", None, None)]
    ranges = nest(df, [Level("d", DateHistogram("ts", "day")), Level("k", Ranges("ts", [
        {"key": "new", "from": "2024-01-03"}, {"key": "old", "to": "2024-01-03"}]))])
    assert sorted(rows(ranges, "d", "k", "k_doc_count")) == [
        (at(2024, 1, d), k, n) for d, k, n in [
            (1, "new", 0), (1, "old", 2), (2, "new", 0), (2, "old", 0), (3, "new", 1), (3, "old", 0)]]


def test_each_level_reads_the_table_once(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    got = nest(orders, [
        Level("status", Terms("o_orderstatus", size=2), {"total": m.sum("o_totalprice")}),
        Level("month", DateHistogram("o_orderdate", "month"), {"mean": m.avg("o_totalprice")})])
    plan = plan_of(got)
    assert plan.count("FileScan") == 2
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double>" in plan


def test_inner_top_k_is_cut_before_the_shuffle(spark):
    """A status that holds most users sends only its best candidates per task."""
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = plan_of(nest(orders, [Level("status", Terms("o_orderstatus", size=2)),
                                 Level("user", Terms("o_custkey", size=3))]))
    assert "row_number(), 3, Partial" in plan


def test_siblings_share_a_pass(spark, people):
    got = aggregations(people, where=Fields(people).range("age", gte=30),
                       measures={"a": m.avg("age"), "b": m.max("age")},
                       buckets={"tags": [Level("tag", Terms("tags"))]}, persist=True)
    assert tuple(got["metrics"].first()) == (32.5, 35)
    assert got["tags"].count() == 4
    got["matches"].unpersist()
    with pytest.raises(ValueError):
        aggregations(people, measures={"a": m.avg("age")}, buckets={"metrics": [Level("t", Terms("tags"))]})


def test_partitioning_does_not_change_results(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([(rng.choice("abcde"), rng.randint(0, 9)) for _ in range(500)], "k string, v int")
    levels = [Level("k", Terms("k", size=3)), Level("v", Terms("v", size=2))]
    one = nest(df.repartition(1), levels).collect()
    many = nest(df.repartition(13, "v"), levels).collect()
    assert Counter(one) == Counter(many)


def test_matrix_stats(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (4.0, 7.0), (9.0, None)], "a double, b double")
    got = {(r.field, r.other): r for r in matrix_stats(df, ["a", "b"]).collect()}
    ab = got["a", "b"]
    xs, ys = [1, 2, 4], [2, 4, 7]
    mx, my = sum(xs) / 3, sum(ys) / 3
    cov = sum((x - mx) * (y - my) for x, y in zip(xs, ys)) / 2
    var = sum((x - mx) ** 2 for x in xs)
    assert ab["count"] == 3 and ab.mean == pytest.approx(mx)
    assert ab.covariance == pytest.approx(cov) and got["b", "a"].covariance == pytest.approx(cov)
    assert ab.variance == pytest.approx(var / 2)
    assert ab.kurtosis == pytest.approx(3 * sum((x - mx) ** 4 for x in xs) / var ** 2)
    assert got["a", "a"].correlation == 1.0


def _passes(spark, run):
    """Scans of the source while ``run`` writes buckets, and the rows of what it returns."""
    plans = []
    real = buckets.written
    buckets.written = lambda df, name: plans.append(plan_of(df)) or real(df, name)
    try:
        found = run()
        return plans, found
    finally:
        buckets.written = real


@pytest.mark.parametrize("where", [None, "false", "n > 3"])
def test_one_pass_equals_a_pass_a_level(spark, where):
    where = where and F.expr(where)
    rng = random.Random(9)
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice([1, 2, 3, None]), rng.choice([0.5, 5.0, 50.0, None]),
             dt.datetime(2024, rng.randrange(1, 7), 3) if rng.random() < 0.9 else None, i % 11) for i in range(400)]
    df = spark.createDataFrame(rows, "s string, k int, x double, at timestamp, n int")
    trees = [
        [Level("s", Terms("s", size=2), {"mean": m.avg("x")}), Level("k", Terms("k", missing=9, exclude=[2])),
         Level("x", Ranges("x", [{"to": 1}, {"from": 1, "to": 10}, {"from": 20}]), {"most": m.max("n")})],
        [Level("at", DateHistogram("at", "month", format="yyyy-MM"), {"total": m.sum("x")}), Level("s", Terms("s", include="a|b"))],
        [Level("x", Ranges("x", [{"to": 1}, {"from": 1}]), {}), Level("at", DateHistogram("at", "month", min_doc_count=2))]]
    for levels in trees:
        plans, once = _passes(spark, lambda: nest(df, levels, where, one_pass=True))
        assert sorted(map(repr, once.collect())) == sorted(map(repr, nest(df, levels, where).collect()))
        assert once.dtypes == nest(df, levels, where).dtypes and len(plans) == 1
    measures = {"mean": m.avg("x"), "n": m.value_count("x")}
    named = {"one": trees[0], "two": trees[1]}
    plans, once = _passes(spark, lambda: aggregations(df, where=where, measures=measures, buckets=named, one_pass=True))
    apart = aggregations(df, where=where, measures=measures, buckets=named)
    assert len(plans) == 1 and plans[0].count("Scan ExistingRDD") <= 1
    for name in apart:
        assert sorted(map(repr, once[name].collect())) == sorted(map(repr, apart[name].collect())), name


def test_one_pass_refuses_levels_with_several_buckets(spark, people):
    with pytest.raises(ValueError, match="several buckets"):
        nest(people, [Level("t", Terms("tags"))], one_pass=True)
