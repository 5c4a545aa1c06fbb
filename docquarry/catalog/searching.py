"""Scans, loading, lookup, paging, projection, sorting, analysis and ranking."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from docquarry.catalog.registry import Catalog, Tables
from docquarry.functions.analysis import ANALYZERS, STANDARD, normalizer
from docquarry.functions.predicates import Fields
from docquarry.operators import postings, ranking, search as s
from docquarry.session import shared_folder
from docquarry.sources.schema import Field, load_json, rejected_json, typed_load

QUERIES = Catalog()
query = QUERIES.query

# Tokens of a document in SQL.
WORDS = r"list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}_]+'), lambda x: x <> '')"


@query("SELECT * FROM customer")
def s1_match_all(t: Tables):
    return t.customer


@query("""
SELECT c_custkey, c_name AS name, upper(c_mktsegment) AS segment_label,
  lower(c_mktsegment) AS segment, coalesce(TRY_CAST(CASE WHEN c_custkey % 10 = 0 THEN 'n/a'
    ELSE CAST(c_nationkey AS VARCHAR) END AS INTEGER), -1) AS nation,
  round(c_acctbal * 10) / 10 AS balance,
  CASE WHEN c_custkey % 7 = 0 THEN 'none' ELSE c_name END AS contact,
  round(c_acctbal * 10) / 10 AS amount, concat_ws(' ', c_name, lower(c_mktsegment)) AS everything
FROM customer""")
def s2_typed_load(t: Tables):
    key = F.col("c_custkey")
    raw = t.customer.select(
        "c_custkey", F.col("c_name").alias("name"),
        F.upper("c_mktsegment").alias("segment_label"), F.col("c_mktsegment").alias("segment"),
        F.when(key % 10 == 0, "n/a").otherwise(F.col("c_nationkey").cast("string")).alias("nation"),
        F.col("c_acctbal").cast("string").alias("balance"),
        F.when(key % 7 != 0, F.col("c_name")).alias("contact"), F.lit("x").alias("undeclared"))
    return typed_load(raw, {
        "name": Field("text", copy_to=("everything",)),
        "segment_label": Field("keyword"),
        "segment": Field("keyword", normalizer="lowercase", copy_to=("everything",)),
        "nation": Field("integer", ignore_malformed=True, null_value=-1),
        "balance": Field("scaled_float", scaling_factor=10),
        "contact": Field("keyword", default="none"),
        "amount": Field("alias", path="balance"),
        "everything": Field("text"),
    }, key="c_custkey")


@query(r"""
SELECT event_id, CAST(regexp_extract(props, '"k": (\d+)', 1) AS INTEGER) AS k,
  'unknown' AS origin FROM events""")
def s2_json_load(t: Tables):
    return load_json(t.events.select("event_id", "props"), "props", {
        "k": Field("integer"), "origin": Field("keyword", default="unknown")}, key="event_id")


@query("SELECT * FROM customer WHERE c_custkey = 42")
def s3_get(t: Tables):
    return s.get(t.customer, 42, key="c_custkey")


@query("""
SELECT * FROM customer WHERE c_custkey IN
  (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 400000)""")
def s3_get_by_ids(t: Tables):
    q = Fields(t.orders)
    ids = t.orders.where(q.bool(filter=[("o_orderstatus", "P"), ("o_totalprice", {"gt": 400000})]))
    return s.get_by_ids(t.customer, ids.select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def s4_search(t: Tables):
    return s.search(t.orders, sort=[s.SortBy("o_totalprice", "desc")], size=20,
                    source={"excludes": ["o_orderdate"]}, key="o_orderkey")


@query("SELECT count(*) AS count FROM events WHERE event_type = 'error'")
def s5_count(t: Tables):
    return s.count(t.events, Fields(t.events).term("event_type", "error"))


@query("""
SELECT least(count(*), 1000) AS value, CASE WHEN count(*) > 1000 THEN 'gte' ELSE 'eq' END AS relation
FROM events WHERE event_type = 'error'""")
def s6_total_capped(t: Tables):
    return s.total_hits(t.events, Fields(t.events).term("event_type", "error"), 1000)


@query("""
SELECT least(count(*), 5000) AS value,
  CASE WHEN count(*) > 5000 THEN 'gte' ELSE 'eq' END AS relation FROM lineitem""")
def s6_total_large_cap(t: Tables):
    """A cap that the table exceeds at every size."""
    return s.total_hits(t.lineitem, None, 5000)


@query("SELECT count(*) AS value, 'eq' AS relation FROM lineitem WHERE l_quantity > 25")
def s6_total_exact(t: Tables):
    return s.total_hits(t.lineitem, Fields(t.lineitem).range("l_quantity", gt=25))


# -- text ---------------------------------------------------------------------
@query(f"""
SELECT doc_id, len(w) AS tokens, len(list_distinct(w)) AS terms
FROM (SELECT doc_id, {WORDS} AS w FROM documents)""")
def t1_analyze(t: Tables):
    words = STANDARD.tokens(F.col("text"))
    return t.documents.select("doc_id", F.size(words).cast("long").alias("tokens"),
                              F.size(F.array_distinct(words)).cast("long").alias("terms"))


@query(r"""
SELECT doc_id, len(list_filter(string_split_regex(lower(text), '[^\p{L}]+'), lambda x: x <> ''
  AND x NOT IN ('a','an','and','are','as','at','be','but','by','for','if','in','into','is','it',
  'no','not','of','on','or','such','that','the','their','then','there','these','they','this','to',
  'was','will','with'))) AS tokens FROM documents""")
def t1_analyze_stop(t: Tables):
    words = ANALYZERS["stop"].tokens(F.col("text"))
    return t.documents.select("doc_id", F.size(words).cast("long").alias("tokens"))


@query("SELECT lower(trim(c_mktsegment)) AS segment, count(*) AS customers FROM customer GROUP BY 1")
def t2_normalize(t: Tables):
    key = normalizer("lowercase_trim").apply(F.col("c_mktsegment"))
    return t.customer.groupBy(key.alias("segment")).agg(F.count("*").alias("customers"))


def _bm25(words: dict[str, str], score: str, where: str) -> str:
    tfs = ", ".join(f"len(list_filter(w, lambda x: x = '{w}')) AS tf_{k}"
                    for k, w in words.items())
    dfs = ", ".join(f"count(*) FILTER (WHERE tf_{k} > 0) AS df_{k}" for k in words)
    return f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
tf AS (SELECT doc_id, len(w) AS dl, {tfs} FROM d),
st AS (SELECT count(*) AS n, avg(dl) AS avgdl, {dfs} FROM tf),
sc AS (SELECT doc_id, {score} AS score FROM tf, st WHERE {where})
"""


def _part(k: str) -> str:
    return (f"ln(1 + (n - df_{k} + 0.5) / (df_{k} + 0.5)) * tf_{k} * 2.2 / "
            f"(tf_{k} + 1.2 * (1 - 0.75 + 0.75 * dl / avgdl))")


@query(_bm25({"a": "the", "b": "and"}, f"{_part('a')} + {_part('b')}", "tf_a > 0 OR tf_b > 0")
       + "SELECT doc_id, round(score, 6) AS score FROM sc ORDER BY score DESC, doc_id LIMIT 20")
def t3_rank_match(t: Tables):
    q = Fields(t.documents, text=["text"])
    hits = ranking.rank(t.documents, must=[ranking.scored_match(q, "text", "the and")],
                        key="doc_id", size=20)
    return hits.select("doc_id", F.round("_score", 6).alias("score"))


@query(_bm25({"a": "the", "b": "und"}, f"{_part('a')} + {_part('b')}", "tf_a > 0 OR tf_b > 0")
       + "SELECT doc_id, round(score, 6) AS score FROM sc ORDER BY score DESC, doc_id LIMIT 20")
def t3_rank_stored_tokens(t: Tables):
    """Texts split once, as a stored column would be; the query is analysed as usual."""
    docs = t.documents.select("doc_id", STANDARD.tokens(F.col("text")).alias("words"))
    q = Fields(docs, text={"words": "keyword"})
    hits = ranking.rank(docs, must=[ranking.scored_match(q, "words", "The und", analyzer="standard")],
                        key="doc_id", size=20)
    return hits.select("doc_id", F.round("_score", 6).alias("score"))


def _stored_postings(t: Tables) -> postings.Postings:
    folder = f"{shared_folder(t.spark)}/postings-{uuid.uuid4().hex}"
    return postings.build(t.documents, "text", folder, key="doc_id", fields=Fields(t.documents, text=["text"]))


@query(_bm25({"a": "the", "b": "and"}, f"{_part('a')} + {_part('b')}", "tf_a > 0 OR tf_b > 0")
       + "SELECT doc_id, round(score, 6) AS score FROM sc ORDER BY score DESC, doc_id LIMIT 20")
def t3_rank_postings(t: Tables):
    """The page of ``t3_rank_match`` from stored postings."""
    hits = _stored_postings(t).rank("The and", size=20)
    return hits.select("doc_id", F.round("_score", 6).alias("score"))


@query(_bm25({"a": "the", "b": "of"}, f"1.5 * ({_part('a')} + {_part('b')})", "tf_a > 0 AND tf_b > 0 AND doc_id % 3 = 0")
       + "SELECT doc_id, round(score, 6) AS score FROM sc ORDER BY score DESC, doc_id LIMIT 15 OFFSET 5")
def t3_rank_postings_and_filter(t: Tables):
    """All words, a boost, a filter on documents, the second page."""
    hits = _stored_postings(t).rank("the of", size=15, from_=5, boost=1.5, operator="AND",
                                    only=t.documents.where(F.col("doc_id") % 3 == 0))
    return hits.select("doc_id", F.round("_score", 6).alias("score"))


@query(_bm25({"a": "of", "b": "und"},
             f"2.0 * ({_part('a')}) + CASE WHEN tf_b > 0 THEN {_part('b')} ELSE 0 END "
             "+ CASE WHEN doc_id % 2 = 0 THEN 0.5 ELSE 0 END", "tf_a > 0")
       + "SELECT doc_id, round(score, 6) AS score FROM sc")
def t3_rank_bool_boost(t: Tables):
    """Every match with its score: a boosted must, an optional text and a constant clause."""
    q = Fields(t.documents, text=["text"])
    hits = ranking.score_all(
        t.documents, must=[ranking.scored_match(q, "text", "of", boost=2.0)],
        should=[ranking.scored_match(q, "text", "und"),
                ranking.scored(F.col("doc_id") % 2 == 0, boost=0.5)])
    return hits.select("doc_id", F.round("_score", 6).alias("score"))


@query(_bm25({"a": "the"}, _part("a"), "tf_a > 0")
       + "SELECT round(max(score), 6) AS max_score FROM sc")
def t3_max_score(t: Tables):
    q = Fields(t.documents, text=["text"])
    hits = ranking.score_all(t.documents, must=[ranking.scored_match(q, "text", "the")])
    return ranking.max_score(hits).select(F.round("max_score", 6).alias("max_score"))


# -- projection, sort, paging -----------------------------------------------------
@query("""
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_linenumber, l_orderkey LIMIT 25 OFFSET 45000""")
def l5_deep_page(t: Tables):
    """Only sort values are dealt into ranges, and only one range is sorted."""
    page = s.search(t.lineitem, sort=[s.SortBy("l_extendedprice", "desc"), "l_linenumber"], from_=45_000, size=25,
                    key="l_orderkey")
    return page.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders")
def l1_source_includes(t: Tables):
    return s.source_filter(t.orders, ["o_order*"], "o_orderkey")


@query("""
SELECT c_custkey, c_name AS name, c_nationkey AS nation FROM customer""")
def l1_source_nested(t: Tables):
    """Sub-fields of an object: one member kept by path, one dropped."""
    docs = t.customer.select("c_custkey", "c_acctbal", F.struct(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment")).alias("who"))
    kept = s.source_filter(docs, {"includes": ["who.*"], "excludes": ["who.seg*"]}, "c_custkey")
    return kept.select("c_custkey", "who.*")


@query("""
SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 25""")
def l2_sort_fields(t: Tables):
    return s.search(t.orders, sort=["o_orderpriority", s.SortBy("o_totalprice", "desc")], size=25,
                    source=["o_orderpriority", "o_totalprice"], key="o_orderkey")


_MISSING = "SELECT event_id, nullif(event_type, 'view') AS kind FROM events"


@query(f"SELECT * FROM ({_MISSING}) ORDER BY kind DESC NULLS FIRST, event_id LIMIT 30")
def l3_sort_missing_first(t: Tables):
    docs = t.events.select("event_id", F.nullif("event_type", F.lit("view")).alias("kind"))
    return s.search(docs, sort=[s.SortBy("kind", "desc", missing="_first")], size=30,
                    key="event_id")


@query(f"SELECT * FROM ({_MISSING}) ORDER BY coalesce(kind, 'd'), event_id LIMIT 30 OFFSET 2000")
def l3_sort_missing_value(t: Tables):
    docs = t.events.select("event_id", F.nullif("event_type", F.lit("view")).alias("kind"))
    return s.search(docs, sort=[s.SortBy("kind", missing="d")], size=30, from_=2000,
                    key="event_id")


_LENGTHS = f"SELECT doc_id, list_transform({WORDS}, lambda x: len(x)) AS lens FROM documents"
_MODES = {"min": "list_min(lens)", "max": "list_max(lens)", "sum": "list_sum(lens)",
          "avg": "list_avg(lens)", "median": "list_median(lens)"}


def _sort_mode(mode: str) -> None:
    def build(t: Tables):
        docs = t.documents.select("doc_id", F.transform(
            STANDARD.tokens(F.col("text")), F.char_length).alias("lens"))
        return s.search(docs, sort=[s.SortBy("lens", "desc", mode=mode)], size=20, source=False,
                        key="doc_id")
    build.__name__ = f"l4_sort_mode_{mode}"
    query(f"SELECT doc_id FROM ({_LENGTHS}) ORDER BY {_MODES[mode]} DESC NULLS LAST, doc_id LIMIT 20")(build)


for _mode in _MODES:
    _sort_mode(_mode)


@query("""
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'
ORDER BY o_totalprice, o_orderkey LIMIT 20 OFFSET 40""")
def l5_page(t: Tables):
    return s.search(t.orders, Fields(t.orders).term("o_orderstatus", "O"),
                    sort=["o_totalprice"], from_=40, size=20, source=["o_totalprice"],
                    key="o_orderkey")


@query("""
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_totalprice < 400000 OR (o_totalprice = 400000 AND o_orderkey > 0)
ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def l5_page_after_key(t: Tables):
    return s.search(t.orders, sort=[s.SortBy("o_totalprice", "desc")], size=20,
                    source=["o_totalprice"], key="o_orderkey", after=[400000.0, 0])


_FORMS = """
SELECT p_partkey, p_name, p_size % 90 AS lat, p_partkey % 180 AS lon, p_partkey % 7 = 0 AS broken FROM part"""


def _forms(t: Tables):
    """Documents that write their fields in each form that is accepted; one in seven is broken."""
    key, lat, lon = F.col("p_partkey"), F.col("p_size") % 90, F.col("p_partkey") % 180
    words = F.split("p_name", " ")
    one = F.to_json(F.struct(words[0].alias("tags"), F.concat_ws(",", lat, lon).alias("at"),
                             F.struct(key.cast("string").alias("k")).alias("items")))
    many = F.to_json(F.struct(words.alias("tags"), F.array(lon, lat).alias("at"),
                              F.array(F.struct(key.alias("k")), F.struct(key.alias("k"))).alias("items")))
    plain = F.to_json(F.struct(words.alias("tags"), F.struct(lat.alias("lat"), lon.alias("lon")).alias("at")))
    doc = F.when(key % 3 == 0, one).when(key % 3 == 1, many).otherwise(plain)
    return t.part.select("p_partkey", F.when(key % 7 == 0, F.concat(F.lit("no "), doc)).otherwise(doc).alias("doc"))


@query(f"""
WITH d AS ({_FORMS}), w AS (SELECT *, string_split(p_name, ' ') AS words FROM d)
SELECT p_partkey, CASE WHEN broken THEN NULL WHEN p_partkey % 3 = 0 THEN words[1]
    ELSE array_to_string(words, ',') END AS tags,
  CASE WHEN NOT broken THEN lat::DOUBLE END AS lat, CASE WHEN NOT broken THEN lon::DOUBLE END AS lon,
  CASE WHEN broken OR p_partkey % 3 = 2 THEN NULL ELSE p_partkey * (p_partkey % 3 + 1) END AS items FROM w""")
def s2_json_forms(t: Tables):
    """One value or a list, one object or a list, points as text, list and object."""
    loaded = load_json(_forms(t), "doc", {
        "tags": Field("keyword", many=True), "at": Field("geo_point"),
        "items": Field("nested", properties={"k": Field("long")})}, key="p_partkey")
    return loaded.select(
        "p_partkey", F.when(F.col("tags").isNotNull(), F.array_join("tags", ",")).alias("tags"), "at.lat", "at.lon",
        F.aggregate("items", F.lit(0).cast("long"), lambda s, e: s + e["k"]).alias("items"))


@query("SELECT p_partkey FROM part WHERE p_partkey % 7 = 0")
def s2_json_rejected(t: Tables):
    return rejected_json(_forms(t), "doc").select("p_partkey")
