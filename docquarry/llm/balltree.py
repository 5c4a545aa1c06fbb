"""Exact top-k inner products by ball trees with branch and bound (10)."""

from __future__ import annotations

import heapq
import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docquarry.llm.common import stored

#: Vectors of a tree, vectors of a leaf, and queries that visit a tree together.
SHARD, LEAF, BLOCK = 8192, 48, 2048
#: Shards that are asked first for a bound to the k-th score.
SEEDS = 4
#: The scores that fit a column.
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def finite(vector: str) -> Column:
    """Components as doubles; null if one is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(~bad, F.transform(vector, lambda x: x.cast("double")))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """floor(1024 x), whole numbers as floats; infinite above 2^1013."""
    with np.errstate(over="ignore"):
        return np.floor(vectors * 1024)


def exactly(vectors: np.ndarray) -> np.ndarray:
    """floor(1024 x) as Python integers."""
    return np.frompyfunc(lambda x: int(x) * 1024 if abs(x) > 2.0 ** 53 else math.floor(x * 1024), 1, 1)(
        vectors).astype(object)


def in_order(score: int) -> bytes:
    """An integer of any size as bytes that sort alike."""
    size = (abs(score).bit_length() + 7) // 8
    if score >= 0:
        return b"\1" + size.to_bytes(2, "big") + score.to_bytes(size, "big")
    return b"\0" + (0xFFFF - size).to_bytes(2, "big") + ((1 << 8 * size) - 1 + score).to_bytes(size, "big")


class Tree:
    """Balls around vectors, halved across the widest direction until LEAF are left."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        with np.errstate(over="ignore", invalid="ignore"):
            self.build(points, ids, rows)

    def build(self, points: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        order = np.arange(len(points))
        nodes: list[list[float]] = []  # from, to, left child or -1, right child
        centers, radii, todo = [], [], [(0, len(points), -1)]
        real = scaled(points)
        while todo:
            a, b, parent = todo.pop()
            at = len(nodes)
            if parent >= 0:
                nodes[parent][2 if nodes[parent][2] < 0 else 3] = at
            nodes.append([a, b, -1, -1])
            own = real[order[a:b]]
            center = own.mean(axis=0)
            off = own - center
            far = np.sqrt((off ** 2).sum(axis=1))
            centers.append(center)
            radii.append(far.max())
            if b - a > LEAF and radii[-1] > 0:
                along = off @ off[far.argmax()]
                half = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(along, half)]
                todo += [(a + half, b, at), (a, a + half, at)]
        self.nodes, self.centers, self.radii = np.array(nodes, np.int64), np.array(centers), np.array(radii)
        self.points, self.ids, self.rows = points[order], ids[order], rows[order]

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.__dict__)
        return out.getvalue()

    @staticmethod
    def load(raw: bytes) -> Tree:
        tree = Tree.__new__(Tree)
        tree.__dict__.update(np.load(io.BytesIO(raw)))
        return tree

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, least: np.ndarray,
               leaves: int = 0):
        """(query, score, id) of the k best for each query that reach ``least``.

        The inner product with a point of a ball is at most that with the center plus the
        radius times the query's length.  Nodes are taken in order of that bound, until it
        is below the k-th score so far (or ``leaves`` leaves are seen).  Where numbers are too
        large for floats, scores are Python integers and such a bound holds nothing back.
        """
        with np.errstate(over="ignore", invalid="ignore"):
            real, points = scaled(queries), scaled(self.points)
            size = np.abs(real).max(initial=0) * np.abs(points).max(initial=0) * max(1, points.shape[1])
            exact, sides = (points, real) if size < 2.0 ** 53 else (exactly(self.points), exactly(queries))
            bound = real @ self.centers.T
            length = np.sqrt((real ** 2).sum(axis=1))
            reach = np.sqrt((self.centers ** 2).sum(axis=1)) + self.radii
            bound += length[:, None] * (self.radii + 1e-9 * reach) + 1e-6
        bound[np.isnan(bound)] = np.inf
        out = []
        for q in range(len(queries)):
            above, floor, seen = bound[q].tolist(), float(least[q]), 0
            best: list[tuple] = []  # the k best so far: score, -id
            heap = [(-above[0], 0)]
            while heap:
                high, node = heapq.heappop(heap)
                if -high < floor or leaves and seen == leaves:
                    break
                a, b, left, right = self.nodes[node]
                if left >= 0:
                    for child in (left, right):
                        if above[child] >= floor:
                            heapq.heappush(heap, (-above[child], child))
                    continue
                seen += 1
                scores = exact[a:b] @ sides[q]
                for i in np.flatnonzero((scores >= floor) & (self.rows[a:b] != own[q])):
                    item = (int(scores[i]), -int(self.ids[a + i]))
                    if len(best) < k:
                        heapq.heappush(best, item)
                    elif item > best[0]:
                        heapq.heapreplace(best, item)
                if len(best) == k:
                    floor = max(floor, best[0][0])
            out += [(q, s, -i) for s, i in best]
        return out


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def _build(table: pa.Table) -> pa.Table:
    tree = Tree(_matrix(table["v"]), np.asarray(table["id"]), np.asarray(table["row"]))
    return pa.table({"dim": table["dim"][:1], "shard": table["shard"][:1],
                     "tree": pa.array([tree.dump()], pa.binary())})


def _search(k: int, leaves: int):
    def run(trees: pa.Table, queries: pa.Table) -> pa.Table:
        found = []
        if len(trees) and len(queries):
            least = np.asarray(queries["least"].fill_null(-np.inf))
            found = Tree.load(trees["tree"][0].as_py()).search(
                _matrix(queries["v"]), np.asarray(queries["row"]), k, least, leaves)
        at = [q for q, _, _ in found]
        return pa.table({"row": pa.array(np.asarray(queries["row"])[at] if at else [], pa.int64()),
                         "place": pa.array([in_order(s) for _, s, _ in found], pa.binary()),
                         "score": pa.array([min(max(s, LOWEST), HIGHEST) for _, s, _ in found], pa.int64()),
                         "id": pa.array([i for _, _, i in found], pa.int64())})
    return run


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """The ``k`` rows of largest inner product for each row whose id is divisible by ``every``.

    Components are scaled to whole numbers first, so scores are exact.  Rows are dealt into
    shards of about SHARD rows, each a ball tree; queries go to all shards in blocks.  A
    few shards are asked first, one leaf each; the k-th score so far travels with
    the query and prunes from the start in all shards.

    Returns ``query_id``, ``rank`` from 1, ``vec_id`` and ``score``; ties go to the smaller
    id.  Vectors that are null or hold null or non-finite components take no part.  Ranks are those
    of the exact scores, however large; a score beyond 64 bits is given as the nearest that
    fits.  Vectors of different length don't meet; empty ones score 0 with each other.  A row
    without id is no query, and comes last among ties.  Of repeated rows each is a row of
    its own: a query and a candidate.  Other columns play no part.
    """
    rows = stored(vectors.select(F.col(id_col).cast("long").alias("id"), finite(vector_col).alias("v"))
                  .where("v IS NOT NULL")
                  .select(F.coalesce("id", F.lit((1 << 63) - 1)).alias("id"), "v", F.size("v").alias("dim"),
                          F.monotonically_increasing_id().alias("row"), F.col("id").isNotNull().alias("named")),
                  "vectors")
    asks = rows.where(F.col("named") & (F.col("id") % every == 0))
    shards = max(1, -(-rows.count() // SHARD))
    blocks = max(1, -(-asks.count() // BLOCK))
    part = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    trees = stored(rows.withColumn("shard", part(shards)).groupBy("dim", "shard").applyInArrow(
        _build, "dim int, shard int, tree binary"), "trees")
    asks = asks.withColumn("block", part(blocks))

    def ask(queries: DataFrame, upto: int, leaves: int) -> DataFrame:
        """Queries in blocks against the first ``upto`` shards."""
        keys = ["dim", "shard", "block"]
        one = (trees.where(F.col("shard") < upto)
               .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
        two = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(upto - 1)))).select(
            *keys, "row", "v", "least")
        return one.groupBy(*keys).cogroup(two.groupBy(*keys)).applyInArrow(
            _search(k, leaves), "row long, place binary, score long, id long")

    best = Window.partitionBy("row").orderBy(F.desc("place"), "id")
    seeds = ask(asks.withColumn("least", F.lit(None).cast("double")), min(shards, SEEDS), 2)
    least = (seeds.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k)
             .select("row", F.when(F.col("score") > LOWEST, F.col("score").cast("double")
                                   - F.abs(F.col("score").cast("double")) * 2.0 ** -50 - 1).alias("least")))
    found = ask(asks.join(least, "row", "left"), shards, 0)
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found.join(asks.select("row", F.col("id").alias("query_id")), "row").select(
        "query_id", "rank", F.when(F.col("id") < (1 << 63) - 1, F.col("id")).alias("vec_id"), "score")


TOP_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 10
"""
