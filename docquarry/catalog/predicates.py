"""Every predicate, and the parent/child and nested relations."""

from __future__ import annotations

import ipaddress

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docquarry.catalog.registry import Catalog, Tables
from docquarry.catalog.searching import WORDS
from docquarry.functions import addresses
from docquarry.functions.analysis import STANDARD
from docquarry.functions.predicates import Fields, bool_
from docquarry.operators import relations, search
from docquarry.sources.schema import Field, typed_load

QUERIES = Catalog()
query = QUERIES.query


def _docs(t: Tables) -> tuple[DataFrame, Fields]:
    return t.documents, Fields(t.documents, text=["text"])


def _word_sql(test: str) -> str:
    return f"SELECT doc_id, lang FROM (SELECT doc_id, lang, {WORDS} AS w FROM documents) WHERE {test}"


def _hits(docs: DataFrame, where) -> DataFrame:
    return docs.where(where).select("doc_id", "lang")


# -- match ---------------------------------------------------------------------
@query(_word_sql("list_has_any(w, ['the', 'of', 'and'])"))
def p1_match_or(t: Tables):
    docs, q = _docs(t)
    return _hits(docs, q.match("text", "The of AND"))


@query(_word_sql("list_has_all(w, ['the', 'of', 'and'])"))
def p1_match_and(t: Tables):
    docs, q = _docs(t)
    return _hits(docs, q.match("text", "the of and", operator="AND"))


@query(_word_sql("len(list_intersect(['the', 'of', 'and'], w)) >= 2"))
def p1_match_minimum(t: Tables):
    docs, q = _docs(t)
    return _hits(docs, q.match("text", "the of and", minimum_should_match=2))


@query(_word_sql("len(list_intersect(['the', 'of', 'und', 'que'], w)) >= 3"))
def p1_match_minimum_percent(t: Tables):
    docs, q = _docs(t)
    return _hits(docs, q.match("text", "the of und que", minimum_should_match="75%"))


@query(_word_sql("len(list_filter(w, lambda x: levenshtein(regexp_replace(x, '[^\\x00-\\x7F]', '?', 'g'), 'attion') <= 1)) > 0 "
                 "OR len(list_filter(w, lambda x: levenshtein(regexp_replace(x, '[^\\x00-\\x7F]', '?', 'g'), 'und') <= 1)) > 0"))
def p1_match_fuzzy(t: Tables):
    docs, q = _docs(t)
    return _hits(docs, q.match("text", "attion und", fuzziness=1, fuzzy_transpositions=False))


@query(_word_sql("len(list_filter(w, lambda x: levenshtein(regexp_replace(x, '[^\\x00-\\x7F]', '?', 'g'), 'attion') <= 2 "
                 "AND starts_with(x, 'at'))) > 0"))
def p1_match_fuzzy_prefix(t: Tables):
    docs, q = _docs(t)
    return _hits(docs, q.match("text", "attion", fuzziness="AUTO", prefix_length=2,
                               fuzzy_transpositions=False))


@query(_word_sql("list_contains(w, 'of')"))
def p1_match_no_words(t: Tables):
    """A query text without words matches nothing, unless asked to match everything."""
    docs, q = _docs(t)
    return _hits(docs, q.bool(must=[
        q.bool(should=[q.match("text", "?!"), q.match("text", "of")]),
        q.match("text", "?!", zero_terms_query="all")]))


@query("SELECT c_custkey FROM customer WHERE c_nationkey = 7 OR c_mktsegment = 'MACHINERY'")
def p1_match_value(t: Tables):
    q = Fields(t.customer)
    return t.customer.where(bool_(should=[
        q.match("c_nationkey", "7"), q.match("c_mktsegment", "MACHINERY"),
        q.match("c_acctbal", "not a number", lenient=True)])).select("c_custkey")


# -- exact values -----------------------------------------------------------------
@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def p2_term(t: Tables):
    return t.customer.where(Fields(t.customer).term("c_mktsegment", "BUILDING")).select(
        "c_custkey", "c_name")


@query("SELECT c_custkey FROM customer WHERE lower(c_mktsegment) = 'building'")
def p2_term_any_case(t: Tables):
    q = Fields(t.customer)
    return t.customer.where(q.term("c_mktsegment", "buiLDing", case_insensitive=True)).select(
        "c_custkey")


@query(_word_sql("list_contains(w, 'le')"))
def p2_term_text(t: Tables):
    docs, q = _docs(t)
    return _hits(docs, q.term("text", "le"))


@query(_word_sql("list_contains(w, 'der')"))
def p2_term_array(t: Tables):
    docs = t.documents.select("doc_id", "lang", STANDARD.tokens(F.col("text")).alias("words"))
    return _hits(docs, Fields(docs).term("words", "der"))


@query("""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1997-01-01'""")
def p3_range_date(t: Tables):
    q = Fields(t.lineitem)
    return t.lineitem.where(q.range("l_shipdate", gte="1996-01-01", lt="1997-01-01")).select(
        "l_orderkey", "l_linenumber", "l_quantity")


@query("""
SELECT event_id FROM events
WHERE ts >= TIMESTAMP '2024-01-10 05:00:00' AND ts <= TIMESTAMP '2024-01-12 05:00:00'""")
def p3_range_format_zone(t: Tables):
    q = Fields(t.events)
    return t.events.where(q.range("ts", gte="10/01/2024", lte="12/01/2024", format="dd/MM/yyyy",
                                  time_zone="-05:00")).select("event_id")


@query("SELECT p_partkey FROM part WHERE p_retailprice > 950 AND p_retailprice <= 1000.5")
def p3_range_number(t: Tables):
    return t.part.where(Fields(t.part).range("p_retailprice", gt=950, lte=1000.5)).select(
        "p_partkey")


def _spans(t: Tables) -> tuple[DataFrame, Fields]:
    docs = t.part.select("p_partkey", F.struct(
        F.col("p_retailprice").alias("gte"),
        (F.col("p_retailprice") + F.col("p_size")).alias("lte")).alias("span"))
    return docs, Fields(docs)


_SPANS = "SELECT p_partkey FROM part WHERE "


@query(_SPANS + "p_retailprice <= 1020 AND p_retailprice + p_size >= 1000")
def p4_range_intersects(t: Tables):
    docs, q = _spans(t)
    return docs.where(q.range("span", gte=1000, lte=1020)).select("p_partkey")


@query(_SPANS + "p_retailprice >= 950 AND p_retailprice + p_size <= 1000")
def p4_range_within(t: Tables):
    docs, q = _spans(t)
    return docs.where(q.range("span", gte=950, lte=1000, relation="WITHIN")).select("p_partkey")


@query(_SPANS + "p_retailprice <= 1000 AND p_retailprice + p_size >= 1020")
def p4_range_contains(t: Tables):
    docs, q = _spans(t)
    return docs.where(q.range("span", gte=1000, lte=1020, relation="CONTAINS")).select("p_partkey")


# -- addresses and dates as ranges -----------------------------------------------------------
def _hosts(t: Tables) -> DataFrame:
    """Customers with an address whose octets come from the key, and the block around it."""
    key, bits = F.col("c_custkey"), F.col("c_nationkey") % 9 + 20
    host = F.concat_ws(".", F.lit("10"), F.lit("7"), (key % 1024 / 256).cast("int"), key % 256)
    raw = t.customer.select("c_custkey", host.alias("host"), F.concat_ws("/", host, bits).alias("net"))
    return typed_load(raw, {"host": Field("ip"), "net": Field("ip_range")}, key="c_custkey")


def _dotted(text: str) -> int:
    return int(ipaddress.ip_address(text))


_HOST_SQL = f"""
WITH a AS (
  SELECT c_custkey, {_dotted("10.7.0.0")} + c_custkey % 1024 AS host,
    CAST(1 AS BIGINT) << (32 - (c_nationkey % 9 + 20)) AS span FROM customer),
b AS (SELECT c_custkey, host, host // span * span AS low, host // span * span + span - 1 AS high FROM a)
SELECT c_custkey FROM b WHERE """


@query(f"{_HOST_SQL} host > {_dotted('10.7.0.9')} AND host <= {_dotted('10.7.2.10')}")
def p3_range_address(t: Tables):
    docs = _hosts(t)
    return docs.where(Fields(docs).range("host", gt="10.7.0.9", lte="10.7.2.10")).select("c_custkey")


@query(f"""
WITH h AS (SELECT c_custkey, {_dotted("10.7.0.0")} + c_custkey % 1024 AS host FROM customer)
SELECT c_custkey, CAST(row_number() OVER (ORDER BY host DESC, c_custkey) AS INTEGER) AS place FROM h
ORDER BY host DESC, c_custkey LIMIT 40""")
def l2_sort_address(t: Tables):
    page = search.search(_hosts(t), sort=[search.SortBy("host", "desc")], size=40, key="c_custkey")
    return page.select("c_custkey", F.row_number().over(
        Window.orderBy(F.desc(addresses.ordered("host")), "c_custkey")).alias("place"))


@query(f"{_HOST_SQL} host BETWEEN {_dotted('10.7.1.64')} AND {_dotted('10.7.1.127')}")
def p2_term_address_block(t: Tables):
    docs = _hosts(t)
    return docs.where(Fields(docs).term("host", "10.7.1.64/26")).select("c_custkey")


@query(f"{_HOST_SQL} low <= {_dotted('10.7.1.12')} AND high >= {_dotted('10.7.0.250')}")
def p4_address_intersects(t: Tables):
    docs = _hosts(t)
    return docs.where(Fields(docs).range("net", gte="10.7.0.250", lte="10.7.1.12")).select("c_custkey")


@query(f"{_HOST_SQL} low >= {_dotted('10.7.0.8')} AND high < {_dotted('10.7.2.0')}")
def p4_address_within(t: Tables):
    docs = _hosts(t)
    return docs.where(Fields(docs).range("net", gte="10.7.0.8", lt="10.7.2.0", relation="WITHIN")).select("c_custkey")


@query(f"{_HOST_SQL} low <= {_dotted('10.7.1.9')} AND high >= {_dotted('10.7.1.20')}")
def p4_address_contains(t: Tables):
    docs = _hosts(t)
    return docs.where(Fields(docs).range("net", gte="10.7.1.9", lte="10.7.1.20",
                                         relation="CONTAINS")).select("c_custkey")


def _transits(t: Tables) -> tuple[DataFrame, Fields]:
    """Lines with the days from shipping as a range of dates."""
    days = F.make_dt_interval(F.col("l_linenumber") * 9)
    raw = t.lineitem.select("l_orderkey", "l_linenumber", F.struct(
        F.col("l_shipdate").alias("gte"), (F.col("l_shipdate") + days).alias("lte")).alias("transit"))
    docs = typed_load(raw, {"l_orderkey": Field("long"), "l_linenumber": Field("integer"),
                            "transit": Field("date_range")}, key=None)
    return docs, Fields(docs)


_TRANSIT_SQL = """
SELECT l_orderkey, l_linenumber FROM (
  SELECT l_orderkey, l_linenumber, l_shipdate AS low, l_shipdate + to_days(CAST(l_linenumber * 9 AS INTEGER)) AS high
  FROM lineitem) WHERE """


@query(_TRANSIT_SQL + "low < TIMESTAMP '1996-03-15' AND high >= TIMESTAMP '1996-03-01'")
def p4_dates_intersect(t: Tables):
    docs, q = _transits(t)
    return docs.where(q.range("transit", gte="1996-03", lt="1996-03-15")).select("l_orderkey", "l_linenumber")


@query(_TRANSIT_SQL + "low > TIMESTAMP '1996-03-01' AND high <= TIMESTAMP '1996-04-15'")
def p4_dates_within(t: Tables):
    docs, q = _transits(t)
    return docs.where(q.range("transit", gt="01/03/1996", lte="15/04/1996", format="dd/MM/yyyy",
                              relation="WITHIN")).select("l_orderkey", "l_linenumber")


@query(_TRANSIT_SQL + "low <= TIMESTAMP '1996-03-10' AND high >= TIMESTAMP '1996-03-20'")
def p4_dates_contain(t: Tables):
    docs, q = _transits(t)
    return docs.where(q.range("transit", gte="1996-03-10", lte="1996-03-20", relation="CONTAINS")).select(
        "l_orderkey", "l_linenumber")


def _typed_events(t: Tables) -> DataFrame:
    return t.events.select("event_id", "value", F.nullif(
        F.col("event_type"), F.lit("view")).alias("kind"))


@query("SELECT event_id FROM events WHERE nullif(event_type, 'view') IS NOT NULL")
def p5_exists(t: Tables):
    docs = _typed_events(t)
    return docs.where(Fields(docs).exists("kind")).select("event_id")


@query(_word_sql("len(list_filter(w, lambda x: len(x) > 15)) > 0"))
def p5_exists_array(t: Tables):
    docs = t.documents.select("doc_id", "lang", F.filter(
        STANDARD.tokens(F.col("text")), lambda w: F.char_length(w) > 15).alias("long_words"))
    return _hits(docs, Fields(docs).exists("long_words"))


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def p6_terms(t: Tables):
    return t.orders.where(Fields(t.orders).terms("o_orderpriority", ["1-URGENT", "5-LOW"])).select(
        "o_orderkey")


@query(_word_sql("list_has_any(w, ['sch', 'eaux'])"))
def p6_terms_array(t: Tables):
    docs = t.documents.select("doc_id", "lang", STANDARD.tokens(F.col("text")).alias("words"))
    return _hits(docs, Fields(docs).terms("words", ["sch", "eaux"]))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 45)""")
def p6_terms_lookup(t: Tables):
    listed = t.part.where(Fields(t.part).range("p_size", gt=45))
    return relations.terms_lookup(t.lineitem, "l_partkey", listed, "p_partkey").select(
        "l_orderkey", "l_linenumber", "l_partkey")


# -- patterns -----------------------------------------------------------------------
@query("SELECT p_partkey, p_name FROM part WHERE starts_with(p_name, 'red')")
def p7_prefix(t: Tables):
    return t.part.where(Fields(t.part).prefix("p_name", "red")).select("p_partkey", "p_name")


@query(_word_sql("len(list_filter(w, lambda x: starts_with(x, 'auf'))) > 0"))
def p7_prefix_text(t: Tables):
    docs, q = _docs(t)
    return _hits(docs, q.prefix("text", "AUF", case_insensitive=True))


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%g_ar'")
def p8_wildcard(t: Tables):
    return t.part.where(Fields(t.part).wildcard("p_name", "*g?ar")).select("p_partkey", "p_name")


@query("SELECT p_partkey, p_name FROM part WHERE p_name ILIKE 'RED%'")
def p8_wildcard_any_case(t: Tables):
    return t.part.where(Fields(t.part).wildcard("p_name", "RED*", case_insensitive=True)).select(
        "p_partkey", "p_name")


@query(_word_sql("len(list_filter(w, lambda x: x LIKE 'a_t%on')) > 0"))
def p8_wildcard_text(t: Tables):
    docs, q = _docs(t)
    return _hits(docs, q.wildcard("text", "a?t*on"))


@query("SELECT p_partkey, p_name FROM part WHERE regexp_full_match(p_name, '(red|hot) (ring|gear)')")
def p9_regexp(t: Tables):
    return t.part.where(Fields(t.part).regexp("p_name", "(red|hot) (ring|gear)")).select(
        "p_partkey", "p_name")


@query(_word_sql("len(list_filter(w, lambda x: regexp_full_match(x, '[st][a-m]{2,4}'))) > 0"))
def p9_regexp_text(t: Tables):
    docs, q = _docs(t)
    return _hits(docs, q.regexp("text", "[st][a-m]{2,4}"))


_NAMES = "string_split(p_name, ' ')"


@query(f"SELECT p_partkey, p_name FROM part WHERE len(list_filter({_NAMES}, "
       "lambda x: damerau_levenshtein(x, 'rign') <= 1)) > 0")
def p10_fuzzy_swap(t: Tables):
    q = Fields(t.part, text=["p_name"])
    return t.part.where(q.fuzzy("p_name", "rign")).select("p_partkey", "p_name")


# DuckDB measures bytes: one plain character stands in for each accented one.
@query(_word_sql(r"len(list_filter(w, lambda x: levenshtein("
                 r"regexp_replace(x, '[^\x00-\x7F]', '?', 'g'), 'mentere') <= 2)) > 0"))
def p10_fuzzy_two_edits(t: Tables):
    docs, q = _docs(t)
    return _hits(docs, q.fuzzy("text", "mentere", fuzziness=2, transpositions=False))


@query("SELECT p_partkey, p_name FROM part WHERE levenshtein(p_name, 'red rung') <= 2")
def p10_fuzzy_value(t: Tables):
    q = Fields(t.part)
    return t.part.where(q.fuzzy("p_name", "red rung", transpositions=False)).select(
        "p_partkey", "p_name")


# Text fields whose tokens keep their case.
@query("SELECT p_partkey, p_name FROM part WHERE len(list_filter(string_split(upper(p_name), ' '), "
       "lambda x: x = 'RING' OR starts_with(x, 'BL') OR x LIKE '%EE_')) > 0")
def p2_p7_p8_case_insensitive(t: Tables):
    docs = t.part.select("p_partkey", F.upper("p_name").alias("p_name"))
    q = Fields(docs, text={"p_name": "whitespace"})
    lower = docs.where(q.bool(should=[
        q.term("p_name", "ring", case_insensitive=True), q.prefix("p_name", "bl", case_insensitive=True),
        q.wildcard("p_name", "*ee?", case_insensitive=True)]))
    return lower.select("p_partkey", F.lower("p_name").alias("p_name"))


# -- geo ------------------------------------------------------------------------------
_LAT, _LON = "(c_custkey * 37 % 180) - 90", "(c_custkey * 73 % 360) - 180"


def _places(t: Tables) -> tuple[DataFrame, Fields]:
    docs = t.customer.select("c_custkey", F.struct(
        F.expr(_LAT).cast("double").alias("lat"),
        F.expr(_LON).cast("double").alias("lon")).alias("location"))
    return docs, Fields(docs)


def _haversine(lat: float, lon: float) -> str:
    return (f"2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians({_LAT} - ({lat})) / 2), 2) + "
            f"cos(radians({_LAT})) * cos(radians({lat})) * "
            f"pow(sin(radians({_LON} - ({lon})) / 2), 2))))")


@query(f"SELECT c_custkey FROM customer WHERE {_haversine(40, -73)} <= 2000")
def p11_geo_distance(t: Tables):
    docs, q = _places(t)
    return docs.where(q.geo_distance("location", distance="2000km", lat=40, lon=-73)).select(
        "c_custkey")


@query(f"SELECT c_custkey FROM customer WHERE {_haversine(5, 175)} <= 1500 * 1.609344")
def p11_geo_distance_dateline(t: Tables):
    docs, q = _places(t)
    return docs.where(q.geo_distance("location", distance="1500mi",
                                     point={"lat": 5, "lon": 175})).select("c_custkey")


@query(f"SELECT c_custkey FROM customer WHERE {_LAT} BETWEEN 0 AND 40 AND {_LON} BETWEEN -100 AND -10")
def p12_geo_box(t: Tables):
    docs, q = _places(t)
    return docs.where(q.geo_bounding_box(
        "location", top_left={"lat": 40, "lon": -100}, bottom_right={"lat": 0, "lon": -10})).select(
        "c_custkey")


@query(f"""
SELECT c_custkey FROM customer
WHERE {_LAT} BETWEEN -30 AND 30 AND ({_LON} >= 150 OR {_LON} <= -160)""")
def p12_geo_box_dateline(t: Tables):
    docs, q = _places(t)
    return docs.where(q.geo_bounding_box(
        "location", top_left={"lat": 30, "lon": 150},
        bottom_right={"lat": -30, "lon": -160})).select("c_custkey")


# -- bool -----------------------------------------------------------------------------
@query("""
SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 100000
AND NOT coalesce(o_orderpriority = '5-LOW', false)""")
def p13_bool(t: Tables):
    """All four clauses: with must and filter present, should does not restrict."""
    q = Fields(t.orders)
    return t.orders.where(q.bool(
        must=[("o_orderstatus", "F")], filter=[("o_totalprice", {"gte": 100000})],
        should=[("o_orderpriority", "1-URGENT")], must_not=[("o_orderpriority", "5-LOW")])).select(
        "o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice BETWEEN 1000 AND 5000")
def p13a_bool_must(t: Tables):
    q = Fields(t.orders)
    return t.orders.where(q.bool(must=[
        ("o_orderstatus", "F"), ("o_totalprice", {"gte": 1000, "lte": 5000})])).select("o_orderkey")


@query("SELECT event_id FROM events WHERE nullif(event_type, 'view') IS DISTINCT FROM 'click'")
def p13b_bool_must_not(t: Tables):
    """Events without a type are kept."""
    docs = _typed_events(t)
    return docs.where(Fields(docs).bool(must_not=[("kind", "click")])).select("event_id")


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') OR o_totalprice < 2000")
def p13c_bool_should(t: Tables):
    q = Fields(t.orders)
    return t.orders.where(q.bool(should=[
        ("o_orderpriority", ["1-URGENT", "2-HIGH"]), ("o_totalprice", {"lt": 2000})])).select(
        "o_orderkey")


@query("SELECT event_id FROM events WHERE nullif(event_type, 'view') = 'error' AND value > 100 AND value <= 200")
def p13d_bool_filter(t: Tables):
    docs = _typed_events(t)
    return docs.where(Fields(docs).bool(filter=[
        ("kind", "error"), ("value", {"gt": 100, "lte": 200})])).select("event_id")


@query("""
SELECT event_id FROM events WHERE coalesce(nullif(event_type, 'view') = 'click', false)::INT
  + (value > 50)::INT + (user_id < 40)::INT >= 2""")
def p13_bool_minimum(t: Tables):
    docs = t.events.select("event_id", "value", "user_id", F.nullif(
        F.col("event_type"), F.lit("view")).alias("kind"))
    return docs.where(Fields(docs).bool(
        should=[("kind", "click"), ("value", {"gt": 50}), ("user_id", {"lt": 40})],
        minimum_should_match=2)).select("event_id")


@query("""
SELECT event_id FROM events WHERE NOT coalesce(nullif(event_type, 'view') IN ('click', 'error')
  AND value > 20, false) AND user_id >= 10""")
def p13_bool_nested(t: Tables):
    docs = t.events.select("event_id", "value", "user_id", F.nullif(
        F.col("event_type"), F.lit("view")).alias("kind"))
    q = Fields(docs)
    inner = q.bool(must=[("kind", ["click", "error"]), ("value", {"gt": 20})])
    return docs.where(q.bool(filter=[("user_id", {"gte": 10})], must_not=[inner])).select("event_id")


# -- relations ----------------------------------------------------------------------------
_BIG = "SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45"


@query(f"SELECT o_orderkey, o_totalprice FROM orders WHERE EXISTS ({_BIG})")
def r1_has_child(t: Tables):
    return relations.has_child(t.orders, t.lineitem, "o_orderkey", "l_orderkey",
                               Fields(t.lineitem).range("l_quantity", gt=45)).select(
        "o_orderkey", "o_totalprice")


@query(f"SELECT o_orderkey, o_totalprice FROM orders WHERE NOT EXISTS ({_BIG})")
def r1_has_no_child(t: Tables):
    return relations.has_child(t.orders, t.lineitem, "o_orderkey", "l_orderkey",
                               Fields(t.lineitem).range("l_quantity", gt=45), negate=True).select(
        "o_orderkey", "o_totalprice")


_FILLED = "SELECT 1 FROM orders WHERE l_orderkey = o_orderkey AND o_orderstatus = 'F'"


@query(f"SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE EXISTS ({_FILLED})")
def r2_has_parent(t: Tables):
    return relations.has_parent(t.lineitem, t.orders, "l_orderkey", "o_orderkey",
                                Fields(t.orders).term("o_orderstatus", "F")).select(
        "l_orderkey", "l_linenumber", "l_quantity")


@query(f"SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE NOT EXISTS ({_FILLED})")
def r2_has_no_parent(t: Tables):
    return relations.has_parent(t.lineitem, t.orders, "l_orderkey", "o_orderkey",
                                Fields(t.orders).term("o_orderstatus", "F"), negate=True).select(
        "l_orderkey", "l_linenumber", "l_quantity")


def _lines(t: Tables) -> DataFrame:
    """Documents with their lines as sub-documents, built inside each row."""
    return t.documents.select("doc_id", "lang", F.transform(
        F.split("text", "\n"), lambda x: F.struct(
            F.char_length(x).alias("chars"), F.regexp_count(x, F.lit(STANDARD.inside + "+")).alias("words"),
            x.alias("line"))).alias("lines"))


_LINE_SQL = r"""
WITH p AS (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line FROM documents),
q AS (SELECT *, len(line) AS chars, len(list_filter(string_split_regex(lower(line),
  '[^\p{L}\p{N}_]+'), lambda x: x <> '')) AS words FROM p)
"""


@query(_LINE_SQL + "SELECT DISTINCT doc_id, lang FROM q WHERE chars > 60 AND words < 10")
def r3_nested(t: Tables):
    docs = _lines(t)
    return _hits(docs, Fields(docs).nested("lines", lambda e: e.bool(must=[
        e.range("chars", gt=60), e.range("lines.words", lt=10)])))


@query(_LINE_SQL + """
SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM q WHERE chars > 60)
AND doc_id IN (SELECT doc_id FROM q WHERE words < 10)""")
def r3_object_array(t: Tables):
    """The same conditions on an object array: not tied to one element."""
    docs = _lines(t)
    q = Fields(docs)
    return _hits(docs, q.bool(must=[q.range("lines.chars", gt=60), q.range("lines.words", lt=10)]))


@query(_LINE_SQL + """
SELECT doc_id, lang FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM q WHERE chars > 60 AND words < 10)""")
def r3_not_nested(t: Tables):
    docs = _lines(t)
    q = Fields(docs)
    return _hits(docs, q.bool(must_not=[q.nested("lines", lambda e: e.bool(must=[
        e.range("chars", gt=60), e.range("words", lt=10)]))]))


@query("SELECT p_partkey, rpad(p_name, 500, 'x') AS p_name FROM part WHERE damerau_levenshtein(p_name, 'red rign') <= 2")
def p10_fuzzy_long_value(t: Tables):
    """Values of 500 characters that agree in all but the first words."""
    docs = t.part.select("p_partkey", F.rpad("p_name", 500, "x").alias("p_name"))
    wanted = "red rign".ljust(500, "x")
    return docs.where(Fields(docs).fuzzy("p_name", wanted, fuzziness=2))
