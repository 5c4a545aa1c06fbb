"""Mixing sources to target weights by Pareto order sampling (4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docquarry.llm.common import stored, word_count

#: Copies of a document at most; a source's target stops at as many times its size.
LIMIT = 3
#: Weights of the sources in order, repeating.
WEIGHTS = (1, 2, 3)
#: Parts of the rank scale; only the part where a source's sample ends is sorted.
PARTS = 4096


def targets(sizes: DataFrame) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from rows of ``source`` and ``size``.

    Sources by code point, null last, share the total by weight; a target stops at LIMIT
    times the source's size, and what is over goes to the others by weight.  In order of
    the level (target by weight) at which they stop, sources are full as long as the level
    of those behind is higher.  One row a source.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]),
                          (F.col("place") - 1) % len(WEIGHTS) + 1)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_stop = Window.orderBy("stop", "place")
    earlier = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    all_ = Window.partitionBy(F.lit(1))
    return (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
            .withColumn("place", F.row_number().over(by_name)).withColumn("weight", weight)
            .withColumn("stop", F.lit(float(LIMIT)) * F.col("source_size") / F.col("weight"))
            .withColumn("left", F.sum("source_size").over(all_)
                        - F.coalesce(F.sum(F.lit(LIMIT) * F.col("source_size")).over(earlier), F.lit(0)))
            .withColumn("open", F.sum("weight").over(all_)
                        - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)))
            .withColumn("level", F.col("left") / F.col("open"))
            .withColumn("order", F.row_number().over(by_stop))
            .withColumn("common", F.min_by("level", F.when(F.col("level") <= F.col("stop"), F.col("order"))).over(all_))
            .select("source", "source_size", F.when(
                F.col("level") > F.col("stop"), F.lit(float(LIMIT)) * F.col("source_size")).otherwise(
                F.least(F.col("common") * F.col("weight"), F.lit(float(LIMIT)) * F.col("source_size"))
            ).alias("target")))


def _drawn(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``id``, ``key`` (hash of the text), ``size``, ``row``, ``source_size``, ``target`` and
    ``copies`` of each row."""
    digits = F.substring(F.md5(F.concat_ws(":", F.col("id").cast("string"), "text").cast("binary")), 1, 12)
    rows = stored(
        docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                    F.col(text_col).alias("text"))
        .select("id", "source", F.xxhash64("text").alias("key"), word_count("text").alias("size"),
                ((F.conv(digits, 16, 10).cast("double") + 0.5) / float(16 ** 12)).alias("u"),
                F.monotonically_increasing_id().alias("row")), "sizes")
    sources = stored(
        targets(rows).withColumn("wanted", F.when(F.col("source_size") > 0, F.col("target")
                                                  / F.col("source_size")).otherwise(0.0))
        .withColumn("certain", F.floor("wanted"))
        .withColumn("rest", F.col("target") - F.col("certain") * F.col("source_size"))
        .withColumn("p", F.col("wanted") - F.col("certain")), "targets")

    def joined(frame: DataFrame, other: DataFrame) -> DataFrame:
        named = other.withColumnRenamed("source", "source_")
        return frame.join(named, F.col("source").eqNullSafe(F.col("source_")), "left").drop("source_")

    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    ranked = joined(rows, sources).withColumn(
        "rank", F.when(F.col("p") > 0, odds / (1 + odds))).withColumn(
        "part", F.floor(F.col("rank") * PARTS))
    parts = ranked.where("p > 0").groupBy("source", "part").agg(
        F.sum("size").alias("words"), F.first("rest").alias("rest"))
    upto = Window.partitionBy("source").orderBy("part")
    ends = (parts.withColumn("before", F.sum("words").over(upto) - F.col("words"))
            .where("before <= rest").groupBy("source")
            .agg(F.max("part").alias("end"), F.max_by("before", "part").alias("before")))
    placed = joined(ranked, ends)
    inside = Window.partitionBy("source", "part").orderBy("rank", "id", "row").rowsBetween(
        Window.unboundedPreceding, 0)
    edge = (placed.where("part = end").select("source", "part", "rank", "id", "row", "size", "rest", "before")
            .withColumn("cut", F.col("before") + F.sum("size").over(inside) <= F.col("rest"))
            .select("row", "cut"))
    drawn = stored(placed.join(edge, "row", "left").select(
        "id", "source", "key", "size", "row", "rank", "source_size", "target", "certain", "rest", "p",
        F.coalesce((F.col("part") < F.col("end")) | F.col("cut"), F.lit(False)).alias("drawn")), "drawn")
    gaps = (drawn.groupBy("source").agg(
        (F.first("rest") - F.sum(F.when(F.col("drawn"), F.col("size")).otherwise(0))).alias("gap"))
        .where("gap > 0"))
    best = (joined(drawn.where("p > 0 AND NOT drawn"), gaps)
            .withColumn("off", F.abs(F.col("size") - F.col("gap"))).where("off < gap")
            .groupBy("source").agg(F.min(F.struct("off", "rank", "id", "row")).alias("best"))
            .select(F.col("best.row").alias("row"), F.lit(1).alias("extra")))
    return drawn.join(best, "row", "left").withColumn(
        "copies", F.col("certain") + F.when(F.col("drawn"), 1).otherwise(0)
        + F.coalesce("extra", F.lit(0)))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """How often the mix takes each document, so that sources come near their targets.

    Each document is wanted target / source_size times.  The whole copies in that are
    certain.  The rest is the inclusion probability p of one copy more: documents are
    ranked by random odds u / (1 - u) divided by the inclusion odds p / (1 - p), and those
    of lowest rank are taken as long as their words fit what is left of the source's
    target.  One more document, the one whose size fits best, closes the gap if that brings
    the source nearer.

    Returns, for each row, ``id_col``, ``size`` (words), ``source_size``, ``target``,
    ``copies`` and ``taken`` (copies times size).  Randomness comes from the id and the
    text, so reruns agree.  Null texts have size 0; a null source is a source, the last;
    null ids are drawn by text.  Repeated rows are drawn one by one.  Without any words all
    targets are 0.  Other columns play no part.
    """
    return _drawn(docs, id_col, text_col, source_col).select(
        F.col("id").alias(id_col), "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           source_col: str = "source") -> DataFrame:
    """All columns of the rows and ``copies``, as ``mix`` has them.

    Rows that agree in id, text and source are drawn one by one; as nothing tells them apart,
    one of them comes out with the copies of all.
    """
    key = [F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_i"), F.xxhash64(text_col).alias("_t"),
           F.coalesce(F.xxhash64(source_col, F.col(source_col).isNull()), F.lit(0)).alias("_s")]
    drawn = _drawn(docs, id_col, text_col, source_col).select(
        F.coalesce(F.col("id").cast("string"), F.lit("")).alias("_i"), F.col("key").alias("_t"),
        F.coalesce(F.xxhash64("source", F.col("source").isNull()), F.lit(0)).alias("_s"), "copies")
    totals = drawn.groupBy("_i", "_t", "_s").agg(F.sum("copies").alias("all"), F.count("*").alias("rows"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *key)
    once = rows.join(totals.where("rows = 1"), ["_i", "_t", "_s"])
    several = rows.join(totals.where("rows > 1"), ["_i", "_t", "_s"]).dropDuplicates(["_i", "_t", "_s"])
    return once.unionByName(several).select("row.*", F.col("all").alias("copies"))


#: The same rows in DuckDB: everything in one window over each source.
MIX_SQL = r"""
WITH s AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    (CAST('0x' || substr(md5(concat_ws(':', CAST(doc_id AS VARCHAR), text)), 1, 12) AS BIGINT) + 0.5::DOUBLE)
      / 281474976710656::DOUBLE AS u
  FROM documents),
t AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM s GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM t),
v AS (SELECT *, CAST((place - 1) % 3 + 1 AS DOUBLE) AS weight FROM w),
c AS (SELECT *, 3::DOUBLE * source_size / weight AS stop FROM v),
l AS (SELECT *, row_number() OVER (ORDER BY stop, place) AS ord,
    CAST(sum(source_size) OVER () AS BIGINT) - CAST(coalesce(sum(3 * source_size) OVER (
      ORDER BY stop, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS rest_size,
    sum(weight) OVER () - coalesce(sum(weight) OVER (
      ORDER BY stop, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open_weight
  FROM c),
k AS (SELECT *, CAST(rest_size AS DOUBLE) / open_weight AS level FROM l),
g AS (SELECT source, source_size, CASE WHEN level > stop THEN 3::DOUBLE * source_size
    ELSE least((SELECT arg_min(level, ord) FROM k WHERE level <= stop) * weight, 3::DOUBLE * source_size)
    END AS target FROM k),
h AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS wanted FROM g),
p AS (SELECT *, CAST(floor(wanted) AS BIGINT) AS certain,
    target - floor(wanted) * source_size AS rest, wanted - floor(wanted) AS p FROM h),
o AS (SELECT s.doc_id, s.size, s.u, p.*,
    CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS odds
  FROM s JOIN p ON s.source IS NOT DISTINCT FROM p.source),
r AS (SELECT *, odds / (1 + odds) AS rank FROM o),
d AS (SELECT *, p > 0 AND sum(size) OVER (PARTITION BY source ORDER BY rank, doc_id
    ROWS UNBOUNDED PRECEDING) <= rest AS drawn FROM r),
e AS (SELECT *, rest - sum(CASE WHEN drawn THEN size ELSE 0 END) OVER (PARTITION BY source) AS gap FROM d),
f AS (SELECT *, CASE WHEN p > 0 AND NOT drawn AND gap > 0 AND abs(size - gap) < gap
    THEN row_number() OVER (PARTITION BY source, p > 0 AND NOT drawn AND gap > 0 AND abs(size - gap) < gap
      ORDER BY abs(size - gap), rank, doc_id) END AS turn FROM e),
x AS (SELECT *, certain + CASE WHEN drawn THEN 1 ELSE 0 END + CASE WHEN turn = 1 THEN 1 ELSE 0 END AS copies FROM f)
SELECT doc_id, size, source_size, target, copies, copies * size AS taken FROM x
"""
