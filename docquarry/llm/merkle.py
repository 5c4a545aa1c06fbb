"""Merkle manifest of a dataset: roots, inclusion proofs and their check (13)."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry.llm.common import crc_sql, partitions, stored

#: Fields of a document that its leaf covers, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_SIBLINGS = "array<struct<slot:int,digest:string>>"
_PATH = f"array<struct<slot:int,others:{_SIBLINGS}>>"
_INDEX_BITS = 33  # of monotonically_increasing_id: the row's number inside its partition


class Forest(NamedTuple):
    """Trees, level by level from below: ``levels`` hold every node with its siblings,
    ``roots`` the last node of each tree and the level it is on."""

    levels: list[DataFrame]
    roots: DataFrame


def field(value: Column) -> Column:
    """``-`` if null, else the number of UTF-8 bytes, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Rows with ``place``, their number from 0 in the given order.

    Rows are dealt out by ranges and sorted inside them; the number of a row is its place
    in its range and the rows of earlier ranges.  Only counts of ranges are gathered.
    Rows that are equal in everything are dealt apart.
    """
    tie = F.monotonically_increasing_id()
    keys = [*order, F.col("__tie")]
    ranges = (rows.withColumn("__tie", tie).repartitionByRange(partitions(rows.sparkSession), *keys)
              .sortWithinPartitions(*keys).drop("__tie").withColumn("__at", F.monotonically_increasing_id()))
    placed = stored(ranges, name).withColumn("__part", F.shiftright("__at", _INDEX_BITS))
    sizes = sorted((r["__part"], r["count"]) for r in placed.groupBy("__part").count().collect())
    before, rows_before = [], 0
    for part, count in sizes:
        before.append((part, rows_before))
        rows_before += count
    offsets = rows.sparkSession.createDataFrame(before, "__part long, __before long")
    inside = F.col("__at").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))
    return (placed.join(F.broadcast(offsets), "__part")  # a row for each partition
            .withColumn("place", F.col("__before") + inside).drop("__part", "__before", "__at"))


def with_siblings(nodes: DataFrame, fan: int) -> DataFrame:
    """Every node with ``slot``, its place among its parent's children, and ``others``, its
    siblings by slot: an equijoin with each computed sibling index."""
    idx = F.col("idx")
    out = nodes.withColumn("slot", (idx % fan).cast("int"))
    for step in range(1, fan):
        at = (idx.bitwiseXOR(F.lit(1)) if fan == 2
              else idx - idx % fan + (idx + step) % fan)
        other = nodes.select(F.col("tree").alias("__tree"), F.col("idx").alias("__idx"),
                             F.col("digest").alias(f"__digest{step}"))
        out = (out.withColumn("__at", at)
               .join(other, (F.col("tree") == F.col("__tree")) & (F.col("__at") == F.col("__idx")), "left")
               .withColumn(f"__slot{step}", (F.col("__at") % fan).cast("int"))
               .drop("__tree", "__idx", "__at"))
    found = F.array(*[F.struct(F.col(f"__slot{s}").alias("slot"), F.col(f"__digest{s}").alias("digest"))
                      for s in range(1, fan)])
    others = F.array_sort(F.filter(found, lambda o: o["digest"].isNotNull()))
    return out.withColumn("others", others.cast(_SIBLINGS)).drop(
        *[f"__{name}{s}" for s in range(1, fan) for name in ("slot", "digest")])


def texts(others: Column) -> Column:
    return F.array_join(F.transform(others, lambda o: o["digest"]), "")


def grown(nodes: DataFrame, fan: int, name: str) -> Forest:
    """All levels above ``nodes`` (tree, idx, size of the tree's level, digest); slot zero of
    each run emits the parent.  Further columns of the lowest level are kept there."""
    most = nodes.agg(F.max("size")).first()[0] or 0
    root = F.col("size") == 1
    roots = nodes.where(root).select("tree", "digest", F.lit(0).alias("level"))
    levels: list[DataFrame] = []
    while most > 1:
        level = stored(with_siblings(nodes.where(~root), fan), f"{name}-{len(levels)}")
        levels.append(level)
        nodes = level.where("slot = 0").select(
            "tree", F.floor(F.col("idx") / fan).alias("idx"), F.ceil(F.col("size") / fan).alias("size"),
            F.sha2(F.concat("digest", texts(F.col("others"))), 256).alias("digest"))
        roots = roots.unionByName(nodes.where(root).select("tree", "digest", F.lit(len(levels)).alias("level")))
        most = -(-most // fan)
    return Forest(levels, stored(roots, f"{name}-roots"))


def paths(nodes: DataFrame, forest: Forest, tops: DataFrame, fan: int, name: str) -> DataFrame:
    """The lowest nodes with ``path``, the siblings of every level up to the root, and what
    ``tops`` (tree, level, path above the tree's root, ...) says of their tree.

    From above, each level takes the paths of its parents.
    """
    said = [c for c in tops.columns if c not in ("tree", "level", "path")]
    above = None
    for height in range(len(forest.levels) - 1, -1, -1):
        ended = tops.where(F.col("level") == height + 1).withColumn("idx", F.lit(0).cast("long"))
        ended = ended.select("tree", "idx", "path", *said)
        parents = ended if above is None else above.select(ended.columns).unionByName(ended)
        parents = parents.select(F.col("tree").alias("__tree"), F.col("idx").alias("__idx"),
                                 F.col("path").alias("__path"), *said)
        step = F.array(F.struct("slot", "others")).cast(_PATH)
        above = (forest.levels[height].withColumn("__up", F.floor(F.col("idx") / fan))
                 .join(parents, (F.col("tree") == F.col("__tree")) & (F.col("__up") == F.col("__idx")))
                 .withColumn("path", F.concat(step, "__path"))
                 .drop("__tree", "__idx", "__path", "__up", "slot", "others"))
        if height:
            above = stored(above, f"{name}-paths-{height}")
    alone = nodes.where("size = 1").join(tops.where("level = 0").drop("level"), "tree")
    return alone if above is None else above.unionByName(alone.select(above.columns))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    def up(below: Column, step: Column) -> Column:
        left = F.filter(step["others"], lambda o: o["slot"] < step["slot"])
        right = F.filter(step["others"], lambda o: o["slot"] > step["slot"])
        return F.sha2(F.concat(texts(left), below, texts(right)), 256)
    return F.aggregate(path, start, up)


def manifest(rows: DataFrame, run: str, key: str, fan: int = 2) -> DataFrame:
    """Trees over ``rows`` with a ``leaf``, one for each value of ``run``, in order of
    ``key``, and a tree over their roots in order of ``run``.

    Adds ``subroot`` and ``root`` (digests), and ``path``: from below to the root, for each
    level the row's slot among at most ``fan`` children and its siblings by slot.

    Null comes first, in both orders; rows of equal key are ordered by leaf, and rows that
    are equal in both are interchangeable: each is a leaf of its own.  Without rows there is
    no root and no row.  Each level is a join of nodes with their siblings by index and
    is written down, so work and shuffles add up to those of a few passes over digests;
    a run that holds most rows is spread like any other.
    """
    if fan < 2:
        raise ValueError("a parent has two children at least")
    own = [F.col(c).asc_nulls_first() for c in (run, key)]
    placed = numbered(rows, [*own, F.col("leaf")], "merkle-leaves")
    trees = placed.groupBy(run).agg(F.min("place").alias("tree"), F.count(F.lit(1)).alias("size"))
    trees = trees.withColumnRenamed(run, "__run")
    nodes = stored(placed.join(trees, F.col(run).eqNullSafe(F.col("__run"))).drop("__run")
                   .withColumn("idx", F.col("place") - F.col("tree")).drop("place")
                   .withColumnRenamed("leaf", "digest"), "merkle-nodes")
    forest = grown(nodes, fan, "merkle")
    over = numbered(forest.roots, [F.col("tree")], "merkle-subroots").withColumnRenamed("level", "height")
    subtrees = forest.roots.count()
    over = stored(over.withColumn("sub", F.col("tree")).withColumn("tree", F.lit(0).cast("long"))
                  .withColumnRenamed("place", "idx").withColumn("size", F.lit(subtrees).cast("long")),
                  "merkle-over")
    top = grown(over, fan, "merkle-top")
    none = top.roots.select("tree", "level", F.array().cast(_PATH).alias("path"), F.col("digest").alias("root"))
    tops = stored(paths(over, top, none, fan, "merkle-top").select(
        F.col("sub").alias("tree"), F.col("height").alias("level"), "path",
        F.col("digest").alias("subroot"), "root"), "merkle-tops")
    return paths(nodes, forest, tops, fan, "merkle").withColumnRenamed("digest", "leaf").drop("tree", "idx", "size")


def leaves(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``lang``, ``leaf`` and ``forged``: the leaf after tampering, which adds 1 to
    ``n_chars`` where 7 divides the crc32 of the decimal id; null if nothing changes."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang",
                       F.col("n_chars").cast("decimal(38,0)").alias("n_chars"), "text")
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    changed = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    return docs.select("doc_id", "lang", digest(*[F.col(c) for c in FIELDS]).alias("leaf"),
                       F.when(hit, digest(*changed)).alias("forged"))


def verified_manifest(docs: DataFrame, fan: int = 2) -> DataFrame:
    """Every document's leaf, roots and proof, and what its proof says after tampering.

    Returns ``doc_id``, ``leaf``, ``subroot`` (of its language), ``root``, ``proof_sha256``
    (of all siblings up to the root), ``folded_root`` (from the tampered or else the
    original leaf and the siblings) and ``verified`` (whether that is the root).  A null
    id sorts first and is not tampered with; nulls in other columns are leaves like any
    other, and a null language is a run, the first.  Repeated rows are leaves of their own.
    Other columns play no part.
    """
    rows = manifest(stored(leaves(docs), "merkle-digests"), "lang", "doc_id", fan)
    proof = F.sha2(F.array_join(F.transform("path", lambda p: texts(p["others"])), ""), 256)
    return (rows.withColumn("folded_root", folded(F.coalesce("forged", "leaf"), F.col("path")))
            .select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified")))


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field_sql(n_chars if c == "n_chars" else c) for c in FIELDS) + ")"


MERKLE_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, {_leaf_sql("n_chars")} AS leaf,
    CASE WHEN {crc_sql("doc_id")} % 7 = 0 AND n_chars IS NOT NULL
      THEN {_leaf_sql("(CAST(n_chars AS HUGEINT) + 1)")} END AS forged
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY lang) AS n FROM d),
lv AS (
  SELECT 0 AS l, lang, CAST(idx AS BIGINT) AS idx, CAST(n AS BIGINT) AS n, leaf AS h FROM leaves
  UNION ALL
  SELECT l + 1, lang, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx))
  FROM lv WHERE n > 1 GROUP BY l, lang, idx // 2, n),
sub AS (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n
  FROM lv WHERE n = 1),
tv AS (
  SELECT 0 AS l, CAST(place AS BIGINT) AS idx, CAST(n AS BIGINT) AS n, h FROM sub
  UNION ALL
  SELECT l + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx))
  FROM tv WHERE n > 1 GROUP BY l, idx // 2, n),
near AS (
  SELECT a.lang, a.idx, o.l AS k, (CASE WHEN s.idx % 2 = 0 THEN 'L' ELSE 'R' END) || coalesce(s.h, '') AS h
  FROM leaves a JOIN lv o ON o.lang IS NOT DISTINCT FROM a.lang AND o.n > 1 AND o.idx = a.idx >> o.l
  LEFT JOIN lv s ON s.lang IS NOT DISTINCT FROM a.lang AND s.l = o.l AND s.idx = xor(o.idx, 1)
  UNION ALL
  SELECT a.lang, a.idx, 1000 + o.l, (CASE WHEN s.idx % 2 = 0 THEN 'L' ELSE 'R' END) || coalesce(s.h, '')
  FROM leaves a JOIN sub ON sub.lang IS NOT DISTINCT FROM a.lang
  JOIN tv o ON o.n > 1 AND o.idx = sub.place >> o.l
  LEFT JOIN tv s ON s.l = o.l AND s.idx = xor(o.idx, 1)),
p AS (
  SELECT lang, idx, list(h ORDER BY k) AS path FROM near GROUP BY lang, idx),
f AS (
  SELECT a.doc_id, a.leaf, sub.h AS subroot, (SELECT h FROM tv WHERE n = 1) AS root,
    sha256(coalesce(array_to_string(list_transform(path, lambda x: x[2:]), ''), '')) AS proof_sha256,
    list_reduce(list_concat([coalesce(forged, leaf)], coalesce(path, [])),
      lambda x, y: CASE WHEN y[1] = 'L' THEN sha256(y[2:] || x) ELSE sha256(x || y[2:]) END) AS folded_root
  FROM leaves a JOIN sub ON sub.lang IS NOT DISTINCT FROM a.lang
  LEFT JOIN p ON p.lang IS NOT DISTINCT FROM a.lang AND p.idx = a.idx)
SELECT *, folded_root = root AS verified FROM f
"""
