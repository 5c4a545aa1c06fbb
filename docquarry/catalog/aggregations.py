"""Metric, bucket, nested and sibling aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from docquarry.catalog.registry import Catalog, Tables
from docquarry.catalog.searching import WORDS
from docquarry.functions import metrics as m
from docquarry.functions.analysis import STANDARD
from docquarry.functions.predicates import Fields
from docquarry.operators.buckets import (
    DateHistogram, Level, Ranges, Terms, aggregations, date_histogram, metrics, nest,
    range_buckets, terms)
from docquarry.operators.matrix import matrix_stats

QUERIES = Catalog()
query = QUERIES.query


# -- metrics ---------------------------------------------------------------------
@query("""
SELECT round(avg(l_extendedprice), 4) AS avg_price,
  round(avg(coalesce(nullif(l_discount, 0), 0.05)), 6) AS avg_discount FROM lineitem""")
def a1_avg(t: Tables):
    discount = F.nullif(F.col("l_discount"), F.lit(0.0))
    return metrics(t.lineitem, {
        "avg_price": F.round(m.avg("l_extendedprice"), 4),
        "avg_discount": F.round(m.avg(discount, missing=0.05), 6)})


@query("""
SELECT round(sum(l_quantity), 2) AS quantity,
  round(sum(l_extendedprice * (1 - l_discount)) / 1000, 2) AS revenue FROM lineitem""")
def a2_sum(t: Tables):
    """A field, and an expression in the place of a script."""
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return metrics(t.lineitem, {"quantity": F.round(m.sum("l_quantity"), 2),
                                "revenue": F.round(m.sum(revenue) / 1000, 2)})


@query("SELECT min(l_extendedprice) AS price, min(l_shipdate) AS first_ship FROM lineitem")
def a3_min(t: Tables):
    return metrics(t.lineitem, {"price": m.min("l_extendedprice"),
                                "first_ship": m.min("l_shipdate")})


@query("SELECT max(l_extendedprice) AS price, max(l_shipdate) AS last_ship FROM lineitem")
def a4_max(t: Tables):
    return metrics(t.lineitem, {"price": m.max("l_extendedprice"),
                                "last_ship": m.max("l_shipdate")})


@query("SELECT count(nullif(event_type, 'view')) AS kinds, count(value) AS vals FROM events")
def a5_value_count(t: Tables):
    return metrics(t.events, {
        "kinds": m.value_count(F.nullif(F.col("event_type"), F.lit("view"))),
        "vals": m.value_count("value")})


@query(f"""
SELECT CAST(sum(len(w)) AS BIGINT) AS words, max(list_max(list_transform(w, lambda x: len(x)))) AS longest,
  round(sum(list_sum(list_transform(w, lambda x: len(x)))) / sum(len(w)), 6) AS avg_length
FROM (SELECT {WORDS} AS w FROM documents)""")
def a5_many_values(t: Tables):
    """Metrics over every element of a multi-valued field."""
    lengths = F.transform(STANDARD.tokens(F.col("text")), F.char_length)
    docs = t.documents.select(lengths.alias("lens"))
    return metrics(docs, {
        "words": m.value_count("lens", many=True),
        "longest": m.max("lens", many=True).cast("long"),
        "avg_length": F.round(m.avg("lens", many=True), 6)})


# Values of a document that may have none: words of a part's name that start with its letter.
_SOME = """(SELECT p_partkey, list_filter(string_split(p_name, ' '), lambda x: len(x) > p_partkey % 9) AS w FROM part)"""


@query(f"""
SELECT CAST(sum(len(w)) AS BIGINT) AS n, round(sum(coalesce(list_sum(list_transform(w, lambda x: len(x))), 0))
    / nullif(sum(len(w)), 0), 6) AS mean,
  CAST(sum(greatest(len(w), 1)) AS BIGINT) AS n_filled, CAST(sum(CASE WHEN len(w) = 0 THEN 100
    ELSE list_sum(list_transform(w, lambda x: len(x))) END) AS DOUBLE) AS total_filled,
  round(sum(CASE WHEN len(w) = 0 THEN 100 ELSE list_sum(list_transform(w, lambda x: len(x))) END)
    / sum(greatest(len(w), 1)), 6) AS mean_filled,
  max(CASE WHEN len(w) = 0 THEN 100 ELSE list_max(list_transform(w, lambda x: len(x))) END)::BIGINT AS largest,
  min(CASE WHEN len(w) = 0 THEN 100 ELSE list_min(list_transform(w, lambda x: len(x))) END)::BIGINT AS smallest,
  CAST(NULL AS DOUBLE) AS none FROM {_SOME}""")
def a1_a5_missing_values(t: Tables):
    """Metrics over lists of which some are empty, with and without a stand-in."""
    words = F.filter(F.split("p_name", " "), lambda x: F.char_length(x) > F.col("p_partkey") % 9)
    docs = t.part.select(F.transform(words, F.char_length).alias("lens"))
    return metrics(docs, {
        "n": m.value_count("lens", many=True), "mean": F.round(m.avg("lens", many=True), 6),
        "n_filled": m.value_count("lens", missing=100, many=True),
        "total_filled": m.sum("lens", missing=100, many=True),
        "mean_filled": F.round(m.avg("lens", missing=100, many=True), 6),
        "largest": m.max("lens", missing=100, many=True).cast("long"),
        "smallest": m.min("lens", missing=100, many=True).cast("long"),
        "none": m.avg(F.array().cast("array<int>"), many=True)})


@query("""
SELECT count(o_totalprice) AS count, min(o_totalprice) AS min, max(o_totalprice) AS max,
  round(avg(o_totalprice), 4) AS avg, round(sum(o_totalprice) / 1000, 2) AS sum_k FROM orders""")
def a6_stats(t: Tables):
    out = metrics(t.orders, {"s": m.stats("o_totalprice")}).select("s.*")
    return out.select("count", "min", "max", F.round("avg", 4).alias("avg"),
                      F.round(F.col("sum") / 1000, 2).alias("sum_k"))


@query("""
SELECT count(*) AS count, round(avg(l_quantity), 6) AS avg, round(sum(l_quantity), 2) AS sum,
  round(sum(l_quantity * l_quantity), 2) AS sum_of_squares,
  round(var_pop(l_quantity), 6) AS variance, round(stddev_pop(l_quantity), 6) AS std_deviation,
  round(avg(l_quantity) + 2 * stddev_pop(l_quantity), 6) AS upper,
  round(avg(l_quantity) - 2 * stddev_pop(l_quantity), 6) AS lower FROM lineitem""")
def a7_extended_stats(t: Tables):
    out = metrics(t.lineitem, {"s": m.extended_stats("l_quantity")}).select("s.*")
    return out.select(
        "count", F.round("avg", 6).alias("avg"), F.round("sum", 2).alias("sum"),
        F.round("sum_of_squares", 2).alias("sum_of_squares"),
        F.round("variance", 6).alias("variance"),
        F.round("std_deviation", 6).alias("std_deviation"),
        F.round("std_deviation_bounds.upper", 6).alias("upper"),
        F.round("std_deviation_bounds.lower", 6).alias("lower"))


# -- terms -----------------------------------------------------------------------
@query("""
SELECT o_orderpriority AS key, count(*) AS doc_count FROM orders GROUP BY 1
ORDER BY 2 DESC, 1 LIMIT 10""")
def a8_terms(t: Tables):
    return terms(t.orders, "o_orderpriority")


@query("""
SELECT o_custkey AS key, count(*) AS doc_count FROM orders GROUP BY 1
ORDER BY 2 DESC, 1 LIMIT 10""")
def a8_terms_many_keys(t: Tables):
    return terms(t.orders, "o_custkey")


@query("""
SELECT source AS key, count(*) AS doc_count FROM documents
WHERE regexp_full_match(source, 'src1.*') AND source NOT IN ('src10', 'src11')
GROUP BY 1 HAVING count(*) >= 2 ORDER BY 1 LIMIT 5""")
def a8_terms_options(t: Tables):
    return terms(t.documents, "source", include="src1.*", exclude=["src10", "src11"],
                 min_doc_count=2, order={"_key": "asc"}, size=5)


@query("""
SELECT coalesce(nullif(event_type, 'view'), 'none') AS key, count(*) AS doc_count,
  round(avg(value), 6) AS mean FROM events GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 3""")
def a8_terms_missing(t: Tables):
    """A stand-in for missing values, ordered by a sub-metric."""
    docs = t.events.select("value", F.nullif(
        F.col("event_type"), F.lit("view")).alias("kind"))
    return terms(docs, "kind", missing="none", order={"mean": "desc"}, size=3,
                 sub={"mean": F.round(m.avg("value"), 6)})


@query(f"""
SELECT key, count(*) AS doc_count FROM
  (SELECT doc_id, unnest(list_distinct({WORDS})) AS key FROM documents)
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25""")
def a8_terms_words(t: Tables):
    """A multi-valued field: a document counts once per distinct value."""
    docs = t.documents.select(STANDARD.tokens(F.col("text")).alias("words"))
    return terms(docs, "words", size=25)


@query("""
SELECT s.key, coalesce(c.n, 0) AS doc_count FROM (SELECT DISTINCT c_nationkey AS key FROM customer) s
LEFT JOIN (SELECT c_nationkey AS key, count(*) AS n FROM customer WHERE c_acctbal > 9900
  GROUP BY 1) c ON s.key = c.key ORDER BY 2 DESC, 1 LIMIT 25""")
def a8_terms_empty(t: Tables):
    return terms(t.customer, "c_nationkey", where=Fields(t.customer).range("c_acctbal", gt=9900),
                 min_doc_count=0, size=25)


# -- date histogram -----------------------------------------------------------------
@query("""
SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS key, count(*) AS doc_count,
  round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def a9_month(t: Tables):
    return date_histogram(t.orders, "o_orderdate", calendar_interval="month",
                          sub={"total": F.round(m.sum("o_totalprice"), 2)})


@query("""
SELECT date_trunc('quarter', o_orderdate)::TIMESTAMP AS key,
  strftime(date_trunc('quarter', o_orderdate), '%Y-%m') AS key_as_string, count(*) AS doc_count
FROM orders GROUP BY 1, 2""")
def a9_quarter_format(t: Tables):
    return date_histogram(t.orders, "o_orderdate", calendar_interval="quarter", format="yyyy-MM")


@query("""
SELECT date_trunc('week', ts)::TIMESTAMP AS key, count(*) AS doc_count FROM events GROUP BY 1""")
def a9_week(t: Tables):
    return date_histogram(t.events, "ts", calendar_interval="1w")


def _grid(step: str, bucket: str, where: str) -> str:
    return f"""
WITH b AS (SELECT {bucket} AS key, count(*) AS n FROM events WHERE {where} GROUP BY 1),
g AS (SELECT unnest(generate_series((SELECT min(key) FROM b), (SELECT max(key) FROM b),
  INTERVAL '{step}')) AS key)
SELECT g.key, coalesce(b.n, 0) AS doc_count FROM g LEFT JOIN b ON g.key = b.key"""


@query(_grid("12 hours", "time_bucket(INTERVAL '12 hours', ts, TIMESTAMP '2024-01-01')", "value > 250"))
def a9_fixed_gaps(t: Tables):
    """Empty buckets between the first and the last one are rows too."""
    return date_histogram(t.events, "ts", fixed_interval="12h",
                          where=Fields(t.events).range("value", gt=250))


@query("""
SELECT time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '2024-01-01 02:00:00') AS key,
  count(*) AS doc_count FROM events WHERE value > 250 GROUP BY 1""")
def a9_fixed_offset(t: Tables):
    return date_histogram(t.events, "ts", fixed_interval="6h", offset="+2h", min_doc_count=1,
                          where=Fields(t.events).range("value", gt=250))


@query("""
SELECT date_trunc('day', ts + INTERVAL 2 HOUR)::TIMESTAMP - INTERVAL 2 HOUR AS key,
  strftime(date_trunc('day', ts + INTERVAL 2 HOUR), '%Y-%m-%d') AS key_as_string,
  count(*) AS doc_count FROM events GROUP BY 1, 2""")
def a9_day_zone(t: Tables):
    """Days of another time zone; the key is the UTC instant they start at."""
    return date_histogram(t.events, "ts", calendar_interval="day", time_zone="+02:00",
                          format="yyyy-MM-dd")


# -- ranges ---------------------------------------------------------------------------
_RANGES = [{"to": 50000}, {"from": 20000, "to": 80000}, {"key": "huge", "from": 500000}]
_RANGE_ROWS = """(VALUES ('*-50000', NULL, 50000.0), ('20000-80000', 20000.0, 80000.0),
  ('huge', 500000.0, NULL)) AS r(key, lo, hi)"""


@query(f"""
SELECT key, CAST(lo AS DOUBLE) AS "from", CAST(hi AS DOUBLE) AS "to",
  (SELECT count(*) FROM lineitem WHERE (lo IS NULL OR l_extendedprice >= lo)
    AND (hi IS NULL OR l_extendedprice < hi)) AS doc_count FROM {_RANGE_ROWS}""")
def a10_ranges(t: Tables):
    return range_buckets(t.lineitem, "l_extendedprice", _RANGES)


@query(f"""
SELECT key, CAST(lo AS DOUBLE) AS "from", CAST(hi AS DOUBLE) AS "to", count(l_quantity) AS doc_count,
  round(avg(l_quantity), 6) AS quantity
FROM {_RANGE_ROWS} LEFT JOIN lineitem ON (lo IS NULL OR l_extendedprice >= lo)
  AND (hi IS NULL OR l_extendedprice < hi) GROUP BY 1, 2, 3""")
def a10_ranges_metric(t: Tables):
    return range_buckets(t.lineitem, "l_extendedprice", _RANGES,
                         sub={"quantity": F.round(m.avg("l_quantity"), 6)})


@query("""
SELECT key, lo AS "from", hi AS "to", (SELECT count(*) FROM orders WHERE (lo IS NULL OR o_orderdate >= lo)
  AND (hi IS NULL OR o_orderdate < hi)) AS doc_count
FROM (VALUES ('*-1995-01-01', NULL, TIMESTAMP '1995-01-01'),
  ('later', TIMESTAMP '1994-06-01', NULL)) AS r(key, lo, hi)""")
def a10_date_ranges(t: Tables):
    """Bounds of date ranges come back as dates."""
    return range_buckets(t.orders, "o_orderdate", [
        {"to": "1995-01-01"}, {"key": "later", "from": "1994-06-01"}])


# -- matrix ------------------------------------------------------------------------------
_FIELDS = ["l_quantity", "l_extendedprice", "l_discount"]


def _matrix_sql() -> str:
    parts = []
    for x in _FIELDS:
        moment = f"(SELECT avg({x}) FROM lineitem)"
        for y in _FIELDS:
            parts.append(f"""
SELECT '{x}' AS field, '{y}' AS other, count(*) AS count, round(avg({x}), 4) AS mean,
  round(var_samp({x}), 2) AS variance,
  round(avg(pow({x} - {moment}, 3)) / pow(avg(pow({x} - {moment}, 2)), 1.5), 5) AS skewness,
  round(avg(pow({x} - {moment}, 4)) / pow(avg(pow({x} - {moment}, 2)), 2), 5) AS kurtosis,
  round(covar_samp({x}, {y}), 2) AS covariance, round(corr({x}, {y}), 6) AS correlation
FROM lineitem""")
    return " UNION ALL ".join(parts)


@query(_matrix_sql())
def a11_matrix_stats(t: Tables):
    out = matrix_stats(t.lineitem, _FIELDS)
    digits = {"mean": 4, "variance": 2, "skewness": 5, "kurtosis": 5, "covariance": 2,
              "correlation": 6}
    return out.withColumns({c: F.round(c, d) for c, d in digits.items()})


# -- nesting -------------------------------------------------------------------------------
_TOP_STATUS = """
s AS (SELECT o_orderstatus AS status, count(*) AS status_doc_count FROM orders GROUP BY 1
  ORDER BY 2 DESC, 1 LIMIT 2)"""


@query(f"""
WITH {_TOP_STATUS}
SELECT status, status_doc_count, date_trunc('month', o_orderdate)::TIMESTAMP AS month,
  count(*) AS month_doc_count, round(sum(o_totalprice), 2) AS total
FROM s JOIN orders ON o_orderstatus = status GROUP BY ALL""")
def a12_terms_then_months(t: Tables):
    return nest(t.orders, [
        Level("status", Terms("o_orderstatus", size=2)),
        Level("month", DateHistogram("o_orderdate", "month"),
              {"total": F.round(m.sum("o_totalprice"), 2)})])


@query(f"""
WITH {_TOP_STATUS},
p AS (SELECT o_orderstatus AS status, o_orderpriority AS priority, count(*) AS priority_doc_count,
  round(avg(o_totalprice), 2) AS mean, row_number() OVER (PARTITION BY o_orderstatus
  ORDER BY count(*) DESC, o_orderpriority) AS place FROM orders GROUP BY 1, 2),
r AS (SELECT * FROM (VALUES ('low', NULL, 100000), ('high', 100000, NULL)) AS v(price, lo, hi))
SELECT status, status_doc_count, priority, priority_doc_count, mean, price,
  CAST(lo AS DOUBLE) AS price_from, CAST(hi AS DOUBLE) AS price_to, (SELECT count(*) FROM orders WHERE o_orderstatus = status AND o_orderpriority = priority
    AND (lo IS NULL OR o_totalprice >= lo) AND (hi IS NULL OR o_totalprice < hi)) AS price_doc_count
FROM s JOIN p USING (status) CROSS JOIN r WHERE place <= 3""")
def a12_three_levels(t: Tables):
    return nest(t.orders, [
        Level("status", Terms("o_orderstatus", size=2)),
        Level("priority", Terms("o_orderpriority", size=3),
              {"mean": F.round(m.avg("o_totalprice"), 2)}),
        Level("price", Ranges("o_totalprice", [
            {"key": "low", "to": 100000}, {"key": "high", "from": 100000}]))],
        one_pass=True)


@query("""
SELECT date_trunc('year', o_orderdate)::TIMESTAMP AS year, y.n AS year_doc_count,
  p.priority, p.priority_doc_count
FROM (SELECT date_trunc('year', o_orderdate) AS o_orderdate, count(*) AS n FROM orders GROUP BY 1) y
JOIN (SELECT date_trunc('year', o_orderdate) AS year, o_orderpriority AS priority,
  count(*) AS priority_doc_count, row_number() OVER (PARTITION BY date_trunc('year', o_orderdate)
  ORDER BY count(*) DESC, o_orderpriority) AS place FROM orders GROUP BY 1, 2) p
ON p.year = y.o_orderdate AND p.place <= 2""")
def a12_years_then_terms(t: Tables):
    return nest(t.orders, [
        Level("year", DateHistogram("o_orderdate", "year")),
        Level("priority", Terms("o_orderpriority", size=2))])


@query("""
SELECT c_mktsegment AS key, count(*) AS doc_count, round(avg(c_acctbal), 4) AS balance
FROM customer GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def a13_terms_with_metric(t: Tables):
    return terms(t.customer, "c_mktsegment", sub={"balance": F.round(m.avg("c_acctbal"), 4)})


@query("""
SELECT o_orderstatus AS key, count(*) AS doc_count, round(avg(o_totalprice), 2) AS avg,
  max(o_totalprice) AS max FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def a14_multi_metric(t: Tables):
    out = terms(t.orders, "o_orderstatus", sub={
        "price": m.multi(avg=m.avg("o_totalprice"), max=m.max("o_totalprice"))})
    return out.select("key", "doc_count", F.round("price.avg", 2).alias("avg"),
                      F.col("price.max").alias("max"))


@query("""
SELECT 'priority' AS agg, o_orderpriority AS key, count(*)::DOUBLE AS value FROM orders
WHERE o_orderstatus = 'F' GROUP BY 2
UNION ALL SELECT 'metrics', 'mean', round(avg(o_totalprice), 2) FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'metrics', 'top', max(o_totalprice) FROM orders WHERE o_orderstatus = 'F'""")
def a15_siblings(t: Tables):
    """Several aggregations of one request, stacked for comparison."""
    found = aggregations(
        t.orders, where=Fields(t.orders).term("o_orderstatus", "F"),
        measures={"mean": F.round(m.avg("o_totalprice"), 2), "top": m.max("o_totalprice")},
        buckets={"priority": [Level("priority", Terms("o_orderpriority"))]}, one_pass=True)
    buckets = found["priority"].select(
        F.lit("priority").alias("agg"), F.col("priority").alias("key"),
        F.col("priority_doc_count").cast("double").alias("value"))
    numbers = found["metrics"].select(F.explode(F.create_map(
        F.lit("mean"), "mean", F.lit("top"), "top")).alias("key", "value"))
    return buckets.unionByName(numbers.select(F.lit("metrics").alias("agg"), "key", "value"))


@query("""
SELECT o_orderpriority AS key, count(*) AS doc_count, round(avg(o_totalprice), 2) AS avg_price,
  max(o_totalprice) AS max_price FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice >= 100000 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def a16_filtered_terms(t: Tables):
    q = Fields(t.orders)
    return terms(t.orders, "o_orderpriority",
                 where=q.bool(must=[q.term("o_orderstatus", "F")],
                              filter=[q.range("o_totalprice", gte=100000)]),
                 sub={"avg_price": F.round(m.avg("o_totalprice"), 2),
                      "max_price": m.max("o_totalprice")})
