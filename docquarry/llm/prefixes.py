"""Prefix trie of conversations by truncation peeling (11)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docquarry.llm.common import crc_sql, partitions, stored

#: A rebuilt conversation takes fewer turns than HEADS from the first of its BLOCK of ids.
HEADS, BLOCK = 6, 100
#: Bytes of the ids of one node that travel as one row.
PACK = 32 << 10

_ROOT = b""
_NONE = hashlib.sha256(b"").hexdigest()
_PATH = "array<struct<depth:int,key:binary,size:long>>"


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``item`` (digest of role and text, null as empty) and ``size``
    (code points of the text); texts go no further.  Rows without ``conv_id`` are dropped."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    spelled = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.unhex(F.sha2(spelled, 256)).alias("item"),
        F.length(text).cast("long").alias("size"))


def rebuilt(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations, and the ids of all conversations, even turnless.

    Conversation c gets the first h turns of conversation c - c % BLOCK, h = crc32(c) % HEADS,
    then its own after its first h.  At most HEADS - 1 turns of a conversation are copied, to
    fewer than BLOCK others.
    """
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "item")
    own = items.withColumn("place", F.row_number().over(order))
    ids = items.select("conv_id").distinct()
    first = (own.where((F.col("conv_id") % BLOCK == 0) & (F.col("place") < HEADS))
             .select(F.col("conv_id").alias("base"), "place", "item", "size"))
    given = (ids.withColumn("head", head).withColumn("base", F.col("conv_id") - F.col("conv_id") % BLOCK)
             .join(first, "base").where("place <= head"))
    columns = ["conv_id", F.col("place").alias("turn"), "item", "size"]
    return given.select(*columns).unionByName(own.where(F.col("place") > head).select(*columns)), ids


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The key of every prefix, from the key of the one before and the turn's digest; rows
    come conversation by conversation, in order."""
    conv, depth, key = None, 0, _ROOT
    for batch in batches:
        depths, keys, parents = [], [], []
        for c, item in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if c != conv:
                conv, depth, key = c, 0, _ROOT
            parents.append(key)
            key = hashlib.blake2b(key + item, digest_size=16).digest()
            depth += 1
            depths.append(depth)
            keys.append(key)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(depths, pa.int32()), pa.array(keys, pa.binary()),
             pa.array(parents, pa.binary()), batch.column(2)], ["conv", "depth", "key", "parent", "size"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of each node that stand together, as texts of at most about PACK bytes."""
    key, first, parts, size = None, None, [], 0
    for batch in batches:
        done = []
        for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if k != key or size > PACK:
                if parts:
                    done.append((key, first, ",".join(parts)))
                key, first, parts, size = k, c, [], 0
            parts.append(str(c))
            size += len(parts[-1]) + 1
        if done:
            yield _rows(done)
    if parts:
        yield _rows([(key, first, ",".join(parts))])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    keys, first, texts = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(first, pa.int64()),
                                       pa.array(texts, pa.string())], ["key", "first", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest a node of its ids, which come in order, piece by piece."""
    key, state = None, None
    for batch in batches:
        done = []
        for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if k != key:
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if done:
            yield _digests(done)
    if state is not None:
        yield _digests([(key, state.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    keys, digests = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())],
                                      ["end", "ends_sha256"])


def id_digests(ends: DataFrame) -> DataFrame:
    """``end`` and ``ends_sha256``: SHA-256 of the ids of each key, ascending, comma-joined.

    Ids are sorted by ranges and packed there, so a key with most of the ids is sorted by
    many tasks.  The hash itself runs over its pieces in turn: one stream a key, of which a
    task holds one piece.
    """
    n = partitions(ends.sparkSession)
    packed = (ends.select("key", "conv").repartitionByRange(n, "key", "conv").sortWithinPartitions("key", "conv")
              .mapInArrow(_packed, "key binary, first long, ids string"))
    return (packed.repartition(n, "key").sortWithinPartitions("key", "first")
            .mapInArrow(_hashed, "end binary, ends_sha256 string"))


def trie(items: DataFrame, ids: DataFrame) -> DataFrame:
    """Every distinct sequence of first turns of the conversations, the empty one included.

    ``items`` has ``conv_id``, ``turn``, ``item`` (what makes turns equal) and ``size``; ``ids``
    the conversations, also those without turns.  Turns are ordered by ``turn`` (null
    first), then ``item``; repeated rows are turns of their own.

    Returns ``node`` and ``parent`` (keys), ``depth``, ``size`` of the last turn, ``conv_id`` (smallest
    member), ``parent_conv_id`` (the parent's; root: null), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` (``(n_convs - 1) * size``, summed over the subtree) and
    ``ends_sha256`` of the ids that end there.  Without conversations there is no node.

    Equal conversations are one sequence with a number of copies.  Truncation peeling runs
    from the greatest depth up: what ends at a depth is merged with the nodes that survive
    from below; then the last turn is stripped and rows are grouped again by what is
    left, adding up members, children, leaves and savings on the way.  The part of a
    sequence that no other shares is a chain, peeled at once by a running sum; so
    there are as many rounds as the deepest shared prefix has turns, and a row holds 32
    bytes for each shared turn.  Keys of prefixes are 128-bit hashes.
    """
    spark = items.sparkSession
    n = partitions(spark)
    prefixes = stored(
        items.select(F.col("conv_id").alias("conv"), "item", "size", "turn").repartition(n, "conv")
        .sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "item").select("conv", "item", "size")
        .mapInArrow(_chained, "conv long, depth int, key binary, parent binary, size long"), "trie-prefixes")
    last = prefixes.groupBy("conv").agg(F.max("depth").alias("depth"), F.max_by("key", "depth").alias("key"))
    ends = stored(ids.select(F.col("conv_id").alias("conv")).join(last, "conv", "left").select(
        "conv", F.coalesce("depth", F.lit(0)).alias("depth"), F.coalesce("key", F.lit(_ROOT)).alias("key")),
        "trie-ends")
    whole = ends.groupBy("depth", "key").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("copies"))
    whole = stored(whole.select("conv", "copies", F.col("depth").alias("length")), "trie-sequences")
    own = prefixes.join(whole, "conv")
    counted = stored(own.groupBy("depth", "key").agg(
        F.count(F.lit(1)).alias("sequences"), F.min("conv").alias("conv"), F.min("copies").alias("copies"),
        F.min("parent").alias("parent"), F.min("size").alias("size")), "trie-counted")

    alone = counted.where("sequences = 1").withColumn("own", (F.col("copies") - 1) * F.col("size"))
    below = Window.partitionBy("conv").orderBy(F.desc("depth"))
    chain = stored(alone.select(
        "depth", "key", "parent", "size", "conv", F.col("copies").alias("n_convs"),
        F.when(F.row_number().over(below) == 1, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.sum("own").over(below.rowsBetween(Window.unboundedPreceding, 0)).alias("saved"),
        (F.min("depth").over(Window.partitionBy("conv")) == F.col("depth")).alias("top")), "trie-chains")
    tops = chain.where("top").select("conv", (F.col("depth") - 1).alias("shared"), "saved")
    sequences = whole.join(tops, "conv", "left").withColumn("depth", F.coalesce("shared", "length"))
    paths = (prefixes.join(sequences.select("conv", F.col("depth").alias("upto")), "conv")
             .where("depth <= upto").groupBy("conv")
             .agg(F.sort_array(F.collect_list(F.struct("depth", "key", "size"))).cast(_PATH).alias("path")))
    hanging = F.col("shared").isNotNull().cast("long")
    ready = stored(sequences.join(paths, "conv", "left").select(
        "depth", F.coalesce("path", F.array().cast(_PATH)).alias("path"), "conv", F.col("copies").alias("n_convs"),
        hanging.alias("n_children"), hanging.alias("n_leaves"),
        F.coalesce("saved", F.lit(0)).cast("long").alias("saved")), "trie-ready")

    deepest, levels, nodes = ready.agg(F.max("depth")).first()[0], [], None
    for depth in range(-1 if deepest is None else deepest, -1, -1):
        rows = ready.where(F.col("depth") == depth).drop("depth")
        if nodes is not None:
            rows = rows.unionByName(nodes.select(
                F.slice("path", 1, depth).alias("path"), "conv", "n_convs", F.lit(1).cast("long").alias("n_children"),
                "n_leaves", "saved"))
        key = F.col("path")[depth - 1]["key"] if depth else F.lit(_ROOT)
        merged = rows.withColumn("key", key).groupBy("key").agg(
            F.first("path").alias("path"), F.min("conv").alias("conv"), F.sum("n_convs").alias("n_convs"),
            F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
        size = F.col("path")[depth - 1]["size"] if depth else F.lit(0).cast("long")
        parent = F.col("path")[depth - 2]["key"] if depth > 1 else F.lit(_ROOT if depth else None).cast("binary")
        nodes = stored(merged.select(
            F.lit(depth).alias("depth"), "key", parent.alias("parent"), size.alias("size"), "conv", "n_convs",
            "n_children", F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"),
            (F.col("saved") + (F.col("n_convs") - 1) * size).alias("saved"), "path"), f"trie-{depth}")
        levels.append(nodes.drop("path"))
    shared = levels[0] if levels else chain.where(F.lit(False)).drop("top")
    for level in levels[1:]:
        shared = shared.unionByName(level)

    columns = ["depth", "key", "parent", "size", "conv", "n_convs", "n_children", "n_leaves", "saved"]
    above = shared.select(F.col("key").alias("up"), F.col("conv").alias("parent_conv_id"))
    joined = shared.unionByName(chain.where("top").select(columns)).join(
        above, F.col("parent") == F.col("up"), "left").drop("up")
    inner = chain.where("NOT top").select(*columns, F.col("conv").alias("parent_conv_id"))
    return (joined.unionByName(inner).join(id_digests(ends), F.col("key") == F.col("end"), "left")
            .select(F.col("key").alias("node"), "parent", "depth", "size", F.col("conv").alias("conv_id"),
                    "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(_NONE)).alias("ends_sha256")))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations (see ``rebuilt``): ``conv_id``, ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Null roles and texts are empty ones; null turns come first; turns of equal number are
    ordered by the digest of role and text.  Rows without ``conv_id`` belong to no conversation
    and are left out.  Other columns play no part.
    """
    items = stored(turns(conversations), "trie-turns")
    nodes = trie(*rebuilt(items))
    return nodes.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs",
                        "n_children", "n_leaves", "saved_tokens", "ends_sha256")


TRIE_SQL = f"""
WITH t AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (
  SELECT c, list({{'r': r, 'x': x}} ORDER BY turn NULLS FIRST, sha256(strlen(r) || ':' || r || x)) AS l
  FROM t GROUP BY c),
h AS (SELECT c, l, {crc_sql("c")} % {HEADS} AS h FROM o),
b AS (
  SELECT h.c, list_concat(list_slice(coalesce(p.l, []), 1, h.h), list_slice(h.l, h.h + 1, len(h.l))) AS s
  FROM h LEFT JOIN o p ON p.c = h.c - h.c % {BLOCK}),
n AS (
  SELECT c, len(s) AS length, d, sha256(CAST(list_slice(s, 1, d) AS VARCHAR)) AS k,
    CASE WHEN d > 0 THEN sha256(CAST(list_slice(s, 1, d - 1) AS VARCHAR)) END AS up,
    CASE WHEN d > 0 THEN length(s[d].x) ELSE 0 END AS size
  FROM b, unnest(range(0, len(s) + 1)) AS u(d)),
g AS (
  SELECT k, d, min(up) AS up, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(size) AS own,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (length = d), '')) AS ends_sha256
  FROM n GROUP BY k, d),
kids AS (SELECT up, count(*) AS n_children FROM g WHERE up IS NOT NULL GROUP BY up),
e AS (SELECT g.*, coalesce(n_children, 0) AS n_children FROM g LEFT JOIN kids ON kids.up = g.k),
sums AS (
  SELECT n.k, CAST(sum(e.own) AS BIGINT) AS saved_tokens,
    CAST(sum(CASE WHEN e.n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves
  FROM e JOIN n ON n.c = e.conv_id AND n.d <= e.d GROUP BY n.k)
SELECT e.conv_id, e.d AS depth, p.conv_id AS parent_conv_id, e.n_convs, e.n_children, n_leaves, saved_tokens,
  e.ends_sha256
FROM e JOIN sums ON sums.k = e.k LEFT JOIN g p ON p.k = e.up
"""
