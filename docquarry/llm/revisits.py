"""Not-modified revisits of web archives, joined to the responses they stand for (1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docquarry.llm.common import partitions, stored

#: Header fields that a 304 answer may renew (RFC 9110, 15.4.5, and the validator it checks).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")


def canonical(url: Column) -> Column:
    """A URL without scheme, "www.", port 80 or 443, fragment, tracking parameters and closing
    slash, its host in lower case."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, "^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    rest = F.regexp_replace(bare, "^[^/?]*", "")
    rest = F.regexp_replace(rest, r"([?&])(utm_[a-z]+|ref|fbclid|gclid)=[^&]*", r"$1")
    rest = F.regexp_replace(F.regexp_replace(rest, "&+", "&"), r"\?&", "?")
    return F.concat(host, F.regexp_replace(rest, r"[/?&]+$", ""))


def _plain(tag: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(F.trim(tag), "^W/", "")


def resolve(records: DataFrame) -> DataFrame:
    """Joins each revisit to the latest earlier full response of its canonical URL.

    ``records``: ``record_id``, ``url``, ``date`` (orderable), ``revisit`` (boolean), ``etag``,
    ``last_modified`` and ``headers`` (map of lower-case names); other columns play no part.
    Returns for each revisit ``record_id``, ``canonical_url``, ``refers_to`` (the response's
    ``record_id``), ``verdict`` and ``headers``.

    The verdict is "resolved" if the entity tags agree (weakly), or, where the revisit has
    none, the modification dates; "unchecked" if it has neither; "etag differs" or "date
    differs" (also if the response lacks it); "no response" if none is earlier.  Headers of
    a resolved or unchecked revisit are the response's, renewed by the PERMITTED ones of
    the revisit; otherwise its own.

    A response of the same date isn't earlier; of several responses of one date the one of
    largest id counts.  Records without URL or date, and revisits of unknown kind, match
    nothing; null ids come first in order.  Repeated revisits are all returned.

    Rows are cut into ranges of (URL, date), so that one URL may fill many of them.  Inside a
    range the response is a window away; what comes from before is carried over with one
    row a URL and range.  Only keys and validators are sorted; headers follow in one join.
    """
    plain = records.select(
        "record_id", canonical(F.col("url")).alias("canonical_url"), "date",
        F.coalesce("revisit", F.lit(True)).alias("revisit"), "etag", "last_modified", "headers")
    matched = plain.where("canonical_url IS NOT NULL AND date IS NOT NULL")
    spark = records.sparkSession
    order = ["date", F.desc("revisit"), "record_id"]
    ranged = stored(matched.select(
        "canonical_url", "date", "revisit", "record_id", "etag", "last_modified")
        .repartitionByRange(partitions(spark), "canonical_url", *order)
        .withColumn("range", F.spark_partition_id()), "captures")
    full = F.when(~F.col("revisit"), F.struct(
        F.col("record_id").alias("id"), "etag", "last_modified", F.lit(True).alias("there")))
    inside = Window.partitionBy("range", "canonical_url").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0)
    near = ranged.withColumn("near", F.last(full, ignorenulls=True).over(inside))
    ends = ranged.where("NOT revisit").groupBy("canonical_url", "range").agg(
        F.max_by(full, F.struct("date", "record_id")).alias("end"))
    spans = ranged.select("canonical_url", "range").distinct().join(ends, ["canonical_url", "range"], "left")
    before = Window.partitionBy("canonical_url").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.withColumn("far", F.last("end", ignorenulls=True).over(before)).where(
        "far IS NOT NULL").select("canonical_url", "range", "far")
    found = (near.where("revisit").join(carried, ["canonical_url", "range"], "left")
             .withColumn("response", F.coalesce("near", "far")))
    tag, dated = F.col("etag").isNotNull(), F.col("last_modified").isNotNull()
    verdict = (F.when(F.col("response").isNull(), "no response")
               .when(tag & ~F.coalesce(_plain(F.col("etag")) == _plain(F.col("response.etag")), F.lit(False)),
                     "etag differs")
               .when(~tag & dated & ~F.coalesce(F.col("last_modified") == F.col("response.last_modified"),
                                                F.lit(False)), "date differs")
               .when(tag | dated, "resolved").otherwise("unchecked"))
    # A record is known by its id and place: ids may repeat.
    place = ["record_id", "canonical_url", "date"]
    judged = found.select(*[F.col(c).alias(f"_{c}") for c in place], verdict.alias("verdict"),
                          F.col("response.id").alias("refers_to")).distinct()
    theirs = matched.where("NOT revisit").select(
        F.col("record_id").alias("_id"), F.col("canonical_url").alias("_url"),
        F.col("headers").alias("old")).dropDuplicates(["_id", "_url"])
    own = plain.where("revisit").join(
        judged, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in place], "left")
    both = own.join(theirs, F.col("refers_to").eqNullSafe(F.col("_id"))
                    & (F.col("canonical_url") == F.col("_url")) & F.col("verdict").isin("resolved", "unchecked"), "left")
    allowed = F.map_filter("headers", lambda k, v: k.isin(*PERMITTED))
    kept = F.map_filter("old", lambda k, v: ~F.coalesce(F.map_contains_key(allowed, k), F.lit(False)))
    merged = F.when(F.col("old").isNull(), F.col("headers")).otherwise(
        F.map_concat(kept, F.coalesce(allowed, F.create_map().cast("map<string,string>"))))
    return both.select("record_id", "canonical_url", F.when(
        F.col("verdict") != "no response", F.col("refers_to")).alias("refers_to"),
        F.coalesce("verdict", F.lit("no response")).alias("verdict"), merged.alias("headers"))


def captures(pages: DataFrame) -> DataFrame:
    """Three crawls of every page as archive records: full answers and revisits.

    The table holds pages, not captures.  Which crawl got a full answer, a wrong validator or
    none follows from the page's number, so that every case comes up at every size.
    """
    one = pages.select("page_id", "url", F.md5(F.coalesce("html", F.lit("")).cast("binary")).alias("md5"),
                       F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("crawl"))
    n = F.col("page_id")
    revisit = ((F.col("crawl") == 1) & (n % 5 != 0)) | ((F.col("crawl") == 2) & (n % 3 != 0))
    date = F.lit(1_700_000_000) + n * 60 + F.col("crawl") * 86_400
    etag = F.when(revisit & (n % 7 == 3), F.lit('"other"')).when(revisit & (n % 13 == 5), F.lit(None)).otherwise(
        F.concat(F.when(revisit & (n % 2 == 0), F.lit("W/")).otherwise(F.lit("")), F.lit('"'),
                 F.substring("md5", 1, 16), F.lit('"')))
    modified = F.lit(1_690_000_000) + n + F.when(revisit & (n % 17 == 6), 5).otherwise(0)
    return one.where("crawl > 0 OR page_id % 11 <> 4").select(
        (n * 3 + F.col("crawl")).alias("record_id"), "url", date.alias("date"), revisit.alias("revisit"),
        etag.alias("etag"), F.when(~(revisit & (n % 19 == 5)), modified).alias("last_modified"),
        F.create_map(F.lit("date"), date.cast("string"),
                     F.lit("cache-control"), F.concat(F.lit("max-age="), (n % 100 + F.col("crawl")).cast("string")),
                     F.lit("content-type"), F.when(revisit, "text/plain").otherwise("text/html"),
                     F.lit("server"), F.concat(F.lit("s"), F.col("crawl").cast("string"))).alias("headers"))


REVISIT_SQL = r"""
WITH u AS (
  SELECT page_id, md5(coalesce(html, '')) AS md5,
    regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM pages),
c AS (
  SELECT page_id, md5, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[^/?]*')), ':(80|443)$', ''), '^www\.', '')
    || regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(bare, '^[^/?]*', ''),
      '([?&])(utm_[a-z]+|ref|fbclid|gclid)=[^&]*', '\1', 'g'), '&+', '&', 'g'), '\?&', '?'), '[/?&]+$', '') AS canonical_url
  FROM u),
x AS (SELECT c.*, crawl, (crawl = 1 AND page_id % 5 <> 0) OR (crawl = 2 AND page_id % 3 <> 0) AS revisit
  FROM c, (VALUES (0), (1), (2)) AS v(crawl) WHERE crawl > 0 OR page_id % 11 <> 4),
r AS (
  SELECT page_id * 3 + crawl AS record_id, canonical_url, revisit, crawl, page_id,
    1700000000 + page_id * 60 + crawl * 86400 AS date,
    CASE WHEN revisit AND page_id % 7 = 3 THEN '"other"' WHEN revisit AND page_id % 13 = 5 THEN NULL
      ELSE '"' || substr(md5, 1, 16) || '"' END AS etag,
    CASE WHEN revisit AND page_id % 19 = 5 THEN NULL
      ELSE 1690000000 + page_id + CASE WHEN revisit AND page_id % 17 = 6 THEN 5 ELSE 0 END END AS last_modified
  FROM x),
a AS (
  SELECT *, last_value(CASE WHEN NOT revisit THEN record_id END IGNORE NULLS) OVER (
    PARTITION BY canonical_url ORDER BY date, revisit DESC, record_id ROWS UNBOUNDED PRECEDING) AS response FROM r),
j AS (
  SELECT a.*, CASE WHEN o.record_id IS NULL THEN 'no response'
      WHEN a.etag IS NOT NULL AND a.etag IS DISTINCT FROM o.etag THEN 'etag differs'
      WHEN a.etag IS NULL AND a.last_modified IS NOT NULL AND a.last_modified IS DISTINCT FROM o.last_modified
        THEN 'date differs'
      WHEN a.etag IS NULL AND a.last_modified IS NULL THEN 'unchecked' ELSE 'resolved' END AS verdict, o.crawl AS old
  FROM a LEFT JOIN r o ON a.response = o.record_id WHERE a.revisit)
SELECT record_id, canonical_url, response AS refers_to, verdict, CAST(date AS VARCHAR) AS date,
  'max-age=' || (page_id % 100 + crawl) AS cache_control,
  CASE WHEN verdict IN ('resolved', 'unchecked') THEN 'text/html' ELSE 'text/plain' END AS content_type,
  's' || CASE WHEN verdict IN ('resolved', 'unchecked') THEN old ELSE crawl END AS server
FROM j
"""
