import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from conftest import ids, plan_of
from docquarry.functions import addresses
from docquarry.functions.predicates import Fields
from docquarry.functions.values import Unparsable
from docquarry.operators import search as s
from docquarry.sources.schema import Field, load_json, struct_type, typed_load

ODD = ["", ".", ":", "::", ":::", "1::2::3", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7:8:9", "1:2:3:4:5:6:7::", "::1:2:3:4:5:6:7:8",
       "1:2:3:4:5:6:7", "01.2.3.4", "1.2.3", "1.2.3.256", "1.2.3.4.5", "::1.2.3.4", "::ffff:1.2.3.4", "1:2:3:4:5:6:1.2.3.4",
       "1:2:3:4:5:6:7:1.2.3.4", "::1.2.3.999", "12345::", "g::", "FE80::A", "fe80::1%eth0", " 1.2.3.4", "1.2.3.4 ", "a.b.c.d",
       "1.2.3.-4", ":1::", "::1:", "1::1.2.3.4", "0:0:0:0:0:0:0:0", "2001:db8::8:800:200c:417a"]


def expected(text):
    try:
        return addresses.packed(text) if "%" not in text else None
    except Unparsable:
        return None


def made(rng):
    if rng.random() < 0.4:
        return str(ipaddress.IPv4Address(rng.getrandbits(32)))
    value = ipaddress.IPv6Address(rng.getrandbits(128) & rng.choice([-1, 0xFFFF << 64, (1 << 40) - 1]))
    return rng.choice([str(value), value.exploded, str(value).upper()])


def test_texts_become_ordered_bytes(spark):
    rng = random.Random(5)
    texts = ODD + [made(rng) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = dict(df.select("i", addresses.ordered(F.col("t")).alias("b")).collect())
    assert [None if got[i] is None else bytes(got[i]) for i in range(len(texts))] == [expected(t) for t in texts]
    back = df.select("t", addresses.spelled(addresses.ordered(F.col("t"))).alias("u")).where("u is not null").collect()
    assert all(addresses.packed(r.t) == addresses.packed(r.u) for r in back)


def test_blocks_are_intervals(spark):
    rng = random.Random(6)
    good = []
    for _ in range(120):
        text = made(rng)
        most = 32 if "." in text else 128
        good.append(f"{text}/{rng.choice([0, most, rng.randrange(most + 1)])}")
    texts = good + ["10.0.0.1", "::1"]
    bad = ["10.0.0.1/33", "::/129", "10.0.0.1/", "10.0.0.1/x", "1.2.3/8", "1.2.3.4/8/9", "/8", "1.2.3.4/-1"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts + bad)], "i int, t string")
    got = dict(df.select("i", addresses.bounds(F.col("t")).alias("b")).collect())
    for i, text in enumerate(texts):
        net = ipaddress.ip_network(text, strict=False)
        ends = tuple(map(addresses.packed, (net[0], net[-1])))
        assert tuple(map(addresses.packed, got[i])) == ends == addresses.block(text), text
    assert [got[len(texts) + i] for i in range(len(bad))] == [None] * len(bad)
    for text in bad:
        with pytest.raises(Unparsable):
            addresses.block(text)


SCHEMA = {"_id": Field("keyword"), "host": Field("ip"), "all": Field("ip", many=True), "net": Field("ip_range")}


@pytest.fixture
def hosts(spark):
    return spark.createDataFrame([
        ("1", "10.0.0.9", ["10.0.0.9", "::1"], ("10.0.0.9", "10.0.0.20")),
        ("2", "10.0.0.10", ["192.168.0.1"], ("10.0.0.10", "10.0.0.12")),
        ("3", "fe80::a", [None], ("10.0.0.200", None)),
        ("4", "FE80:0:0:0:0:0:0:A", [], (None, "9.255.255.255")),
        ("5", None, None, None)], struct_type(SCHEMA))


def test_addresses_compare_as_addresses(hosts):
    q = Fields(hosts)
    assert ids(hosts.where(q.range("host", gte="10.0.0.9", lt="10.0.0.11"))) == ["1", "2"]
    assert ids(hosts.where(q.range("host", gt="10.0.0.9"))) == ["2", "3", "4"]
    assert ids(hosts.where(q.term("host", "fe80::000a"))) == ["3", "4"]
    assert ids(hosts.where(q.match("host", "10.0.0.0/29"))) == []
    assert ids(hosts.where(q.terms("host", ["10.0.0.8/30", "fe80::/10"]))) == ["1", "2", "3", "4"]
    assert ids(hosts.where(q.clause("all", {"lt": "10.0.0.0"}))) == ["1"]
    assert ids(hosts.where(q.term("all", "192.168.0.0/16"))) == ["2"]
    assert ids(hosts.where(q.bool(must_not=[q.range("host", gte="10.0.0.10")]))) == ["1", "5"]
    with pytest.raises(Unparsable):
        q.range("host", gte="10.0.0")
    assert ids(hosts.where(q.match("host", "nowhere", lenient=True))) == []


def test_relations_of_address_ranges(hosts):
    q = Fields(hosts)
    find = lambda **b: ids(hosts.where(q.range("net", **b)))
    assert find(gte="10.0.0.10", lte="10.0.0.12") == ["1", "2"]
    assert find(gt="10.0.0.12") == ["1", "3"]
    assert find(lt="10.0.0.9") == ["4"]
    assert find(gte="10.0.0.9", lte="10.0.0.20", relation="WITHIN") == ["1", "2"]
    assert find(gte="10.0.0.10", lte="10.0.0.12", relation="WITHIN") == ["2"]
    assert find(gte="10.0.0.10", lte="10.0.0.12", relation="CONTAINS") == ["1", "2"]
    assert find(gte="10.0.1.0", lte="ff00::", relation="CONTAINS") == ["3"]


def test_sorting_by_address(hosts):
    order = lambda *sort: [r["_id"] for r in s.search(hosts, sort=list(sort)).collect()]
    assert order("host") == ["1", "2", "3", "4", "5"]
    assert order(s.SortBy("host", "desc", missing="10.0.0.9"))[2:] == ["2", "1", "5"]
    assert order(s.SortBy("all", mode="min"))[:2] == ["1", "2"]


def test_loading(spark):
    raw = spark.createDataFrame([("1", "10.0.0.1", "10.0.0.0/30"), ("2", None, None)], "_id string, host string, net string")
    kinds = {"host": Field("ip"), "net": Field("ip_range")}
    assert [tuple(r) for r in typed_load(raw, kinds).orderBy("_id").collect()] == [
        ("1", "10.0.0.1", ("10.0.0.0", "10.0.0.3")), ("2", None, None)]
    bad = raw.select("_id", F.lit("10.0.0").alias("host"))
    with pytest.raises(Exception, match="malformed address"):
        typed_load(bad, kinds).collect()
    assert typed_load(bad, {"host": Field("ip", ignore_malformed=True)}).where("host is not null").count() == 0
    docs = spark.createDataFrame([('{"net": "::/126"}',), ('{"net": {"gte": "1.2.3.4", "lte": "1.2.3.5"}}',)], "doc string")
    assert sorted(tuple(r.net) for r in load_json(docs, "doc", kinds, key=None).collect()) == [
        ("0000:0000:0000:0000:0000:0000:0000:0000", "0000:0000:0000:0000:0000:0000:0000:0003"), ("1.2.3.4", "1.2.3.5")]


def test_bytes_reach_the_reader(spark, hosts, tmp_path):
    stored = hosts.select("_id", addresses.ordered(F.col("host")).alias("host", metadata=hosts.schema["host"].metadata))
    stored.write.parquet(str(tmp_path / "hosts"))
    back = spark.read.parquet(str(tmp_path / "hosts"))
    found = back.where(Fields(back).range("host", gt="10.0.0.9", lte="10.0.0.10"))
    assert ids(found) == ["2"]
    pushed = plan_of(found).split("PushedFilters: [")[1].split("], ReadSchema")[0]
    assert "GreaterThan(host" in pushed and "LessThanOrEqual(host" in pushed
