"""Near-duplicates by fast similarity sketching, banding and exact verification (8)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.llm.common import Hasher, binaries, mix, pieces, stored, words_of
from docquarry.llm.components import components

#: Coordinates of a sketch, and coordinates of a band.  32 bands of 4 miss a pair of
#: similarity 0.8 with probability 5e-8.
COORDINATES, BAND = 128, 4
#: Bytes of sets that are compared in one block with each other, or with another block's.
BLOCK = 16 << 20
#: Stand-ins for missing ids begin here, above all ids.
NO_IDS = 1 << 62

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Shingles:
    """Distinct word shingles of texts, as 64-bit hashes."""

    def __init__(self, words: int) -> None:
        self.words, self.one = words, Hasher(81)

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, hash), sorted, each once.  With fewer words, all of them are one shingle."""
        data = _LOWER[data]
        starts, ends, rows = words_of(data, offsets)
        hashes = self.one.slices(data, starts, ends)
        full = self.one.windows(hashes, self.words)
        row = rows[:len(full)]
        whole = row == rows[self.words - 1:][:len(full)]
        row, full = row[whole], full[whole]
        counts = np.bincount(rows, minlength=len(offsets) - 1)
        few = np.flatnonzero((counts > 0) & (counts < self.words))
        if len(few):
            first = np.searchsorted(rows, few)
            extra = np.array([self.one.windows(hashes[f:f + n], n)[0] ^ np.uint64(n)
                              for f, n in zip(first, counts[few])], np.uint64)
            row, full = np.concatenate([row, few]), np.concatenate([full, extra])
        order = np.lexsort((full, row))
        row, full = row[order], full[order]
        if len(row):
            new = np.r_[True, (row[1:] != row[:-1]) | (full[1:] != full[:-1])]
            row, full = row[new], full[new]
        return row, full


def sketches(row: np.ndarray, items: np.ndarray, rows: int, t: int = COORDINATES) -> np.ndarray:
    """Fast similarity sketch of each row's set: t coordinates that agree between two sets
    with the probability of their Jaccard similarity.

    In rounds 0 to t-1 every item falls into a coordinate chosen by hashing, in rounds t
    to 2t-1 all fall into coordinate round - t, so that every one is filled.  A coordinate
    keeps the smallest value of the first round that reaches it; a row stops when it is full.
    """
    out = np.full(rows * t, np.iinfo(np.uint64).max, np.uint64)
    filled = np.zeros(rows * t, bool)
    base = row * t
    for turn in range(2 * t):
        if not len(items):
            break
        value = mix(items ^ np.uint64((turn + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        at = base + (value % np.uint64(t)).astype(np.int64) if turn < t else base + turn - t
        free = ~filled[at]
        at, value = at[free], value[free]
        np.minimum.at(out, at, np.uint64(turn << 56) | (value >> np.uint64(8)))
        filled[at] = True
        open_ = ~filled.reshape(rows, t).all(axis=1)
        keep = open_[base // t]
        items, base = items[keep], base[keep]
    return out.reshape(rows, t)


def _signatures(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, hasher = Shingles(words), Hasher(82)
        for batch in batches:
            for first, data, offsets in pieces(batch.column("text")):
                n = len(offsets) - 1
                row, items = shingles.of(data, offsets)
                count = np.bincount(row, minlength=n)
                sets = [np.zeros(n, np.uint64) for _ in range(2)]
                for one, seed in zip(sets, (0xA5A5, 0x5A5A)):
                    np.add.at(one, row, mix(items ^ np.uint64(seed)))
                coords = sketches(row, items, n).reshape(n * COORDINATES // BAND, BAND)
                bands = np.arange(len(coords), dtype=np.uint64) % np.uint64(COORDINATES // BAND)
                step = np.uint64(hasher.base & ((1 << 64) - 1))
                for i in range(BAND):
                    bands = mix(bands * step + coords[:, i])
                bands = bands.view(np.int64).reshape(n, -1)
                offset = np.arange(n + 1, dtype=np.int32) * bands.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("k").slice(first, n), batch.column("th").slice(first, n),
                     pa.array(sets[0].view(np.int64)), pa.array(sets[1].view(np.int64)),
                     pa.array(count.astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(offset), pa.array(bands.reshape(-1)))],
                    ["k", "th", "c1", "c2", "n", "bands"])
    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for batch in batches:
            for first, data, offsets in pieces(batch.column("text")):
                n = len(offsets) - 1
                row, items = shingles.of(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("k").slice(first, n),
                     binaries(items, np.bincount(row, minlength=n))], ["rep", "items"])
    return run


def _similar(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                one, two = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                both = np.sort(np.concatenate([one, two]))
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose full sets are similar enough."""
    one = sets.select(F.col("rep").alias("a"), F.col("items").alias("x"))
    two = sets.select(F.col("rep").alias("b"), F.col("items").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(
        _similar(percent), "a long, b long")


def _compared(percent: int):
    """Similar pairs of different components among the members of one group, or across two
    parts of it.  Each member that isn't in the most common component is held against all
    others at once."""
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        rep, label, part = (np.asarray(table.column(c)) for c in ("rep", "label", "part"))
        sizes, items = [], []
        for value in table.column("items"):
            items.append(np.frombuffer(value.as_py(), np.uint64))
            sizes.append(len(items[-1]))
        sizes, (_, flat) = np.array(sizes), np.unique(np.concatenate(items), return_inverse=True)
        ends = np.cumsum(sizes)
        names, counts = np.unique(label, return_counts=True)
        mark, across, out = np.zeros(flat.max() + 1, bool), len(set(part)) > 1, [[], []]
        for x in np.flatnonzero(label != names[counts.argmax()]):
            own = flat[ends[x] - sizes[x]:ends[x]]
            mark[own] = True
            common = np.add.reduceat(mark[flat].astype(np.int64), ends - sizes)
            mark[own] = False
            good = 100 * common >= percent * (sizes + sizes[x] - common)
            good &= label != label[x]
            if across:
                good &= part != part[x]
            for y in np.flatnonzero(good):
                out[0].append(rep[x])
                out[1].append(rep[y])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["a", "b"])
    return run


def _labelled(frame: DataFrame, labels: DataFrame, node: str, label: str) -> DataFrame:
    named = labels.select(F.col("node").alias(node), F.col("component").alias(label))
    return frame.join(named, node, "left").withColumn(label, F.coalesce(label, node))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Components of documents whose sets of word shingles have at least ``percent`` % of
    their union in common.

    Returns, for each row, ``id_col``, ``n_shingles``, ``component_id`` (the smallest id
    reachable over links) and ``kept`` (whether that is the row's own id).

    Equal sets are one class, known by its smallest id; only classes are compared.  Classes
    that agree in a band share a bucket.  The most central class of a bucket, that with most
    company in its own buckets, stands for it.  First every class is compared with the most
    central one it meets, and components are formed.  Then the classes that meet one center
    are compared, in blocks inside a task, as far as they are in different components still.
    So a group of near copies costs a pair a member and a comparison for each that is left;
    pairs are not written out, and no two classes of a bucket go unseen.

    Null and blank texts have no shingles, and link with nothing.  Rows without id count
    as larger than all others; ``component_id`` is null if no row of the component has an
    id.  Rows that share an id are one document with several texts.  Repeated rows come out
    as often as they come in.  Other columns play no part.
    """
    frame = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    frame = frame.withColumn("th", F.xxhash64("text")).select(
        F.coalesce("id", F.lit(NO_IDS) + F.shiftrightunsigned("th", 2)).alias("k"), "th", "text")
    rows = stored(frame.mapInArrow(
        _signatures(words), "k long, th long, c1 long, c2 long, n long, bands array<long>"), "sketches")
    classes = rows.where("n > 0").groupBy("c1", "c2").agg(F.min("k").alias("rep"))
    rows_of = rows.join(classes, ["c1", "c2"], "left").withColumn("rep", F.coalesce("rep", "k"))
    reps = stored(rows_of.where("n > 0 AND k = rep").select("rep", "th", "bands"), "classes")
    members = reps.select("rep", F.explode("bands").alias("h"))
    full = members.groupBy("h").agg(F.count("*").alias("size"), F.min("rep").alias("x"),
                                    F.max("rep").alias("y")).where("x < y").select("h", "size")
    met = stored(members.join(full, "h"), "buckets")
    mass = met.groupBy("rep").agg(F.sum("size").alias("mass"))
    first_of = lambda c: F.max(F.struct("mass", (-F.col(c)).alias("minus")))
    pivots = met.join(mass, "rep").groupBy("h").agg(first_of("rep").alias("best")).select(
        "h", F.col("best.mass").alias("mass"), (-F.col("best.minus")).alias("p"))
    shared = stored(met.select("h", "rep").join(pivots, "h").select("rep", "p", "mass").distinct(), "centers")
    wanted = reps.select("rep", "th").join(shared.select("rep").distinct(), "rep", "left_semi")
    sets = stored(frame.join(wanted.select(F.col("rep").alias("k"), "th").distinct(), ["k", "th"],
                             "left_semi").select("k", "text").mapInArrow(
        _sets(words), "rep long, items binary").distinct(), "sets")

    # Rows of one id with different texts belong together.
    links = (rows_of.where("n > 0").groupBy("k").agg(F.min("rep").alias("b"), F.max("rep").alias("q"))
             .where("b < q").select("k", "b")
             .join(rows_of.where("n > 0").select("k", F.col("rep").alias("a")), "k").select("a", "b"))
    first = (shared.where("rep <> p").groupBy("rep").agg(first_of("p").alias("best"))
             .select((-F.col("best.minus")).alias("a"), F.col("rep").alias("b")))
    labels = components(links.unionByName(_verified(first, sets, percent)))
    groups = _labelled(shared.select("p", "rep"), labels, "rep", "label")
    open_ = (groups.groupBy("p").agg(F.min("label").alias("x"), F.max("label").alias("y"))
             .where("x < y").select("p"))
    held = stored(groups.join(open_, "p").join(
        sets.select("rep", F.octet_length("items").alias("bytes")), "rep"), "groups")
    parts = held.groupBy("p").agg((F.ceil(F.sum("bytes") / F.lit(BLOCK)) - 1).cast("int").alias("last"))
    part = F.pmod(F.xxhash64("rep"), F.col("last") + 1).cast("int")
    blocks = (held.join(parts, "p").withColumn("part", part)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
              .select("p", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
                      "part", "label", "rep"))
    found = blocks.join(sets, "rep").groupBy("p", "i", "j").applyInArrow(
        _compared(percent), "a long, b long")
    labels = components(labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
                        .unionByName(found))
    out = _labelled(rows_of.select("k", "n", "rep"), labels, "rep", "component")
    real = lambda c: F.when(F.col(c) < NO_IDS, F.col(c))
    return out.select(real("k").alias(id_col), F.col("n").alias("n_shingles"),
                      real("component").alias("component_id"),
                      real("k").eqNullSafe(real("component")).alias("kept"))


#: The same rows in DuckDB, for shingles of four words and 80 %: all pairs with a common shingle.
NEAR_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i, len(w) AS total FROM d),
g AS (SELECT doc_id, i, total, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i
    ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS shingle FROM p),
s AS (SELECT DISTINCT doc_id, shingle FROM g WHERE i <= total - 3 OR (total < 4 AND i = 1)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y
  ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * common >= 80 * (na.n + nb.n - common)),
r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT documents.doc_id, coalesce(n, 0) AS n_shingles, component_id, documents.doc_id = component_id AS kept
FROM documents LEFT JOIN n ON n.doc_id = documents.doc_id JOIN m ON m.doc_id = documents.doc_id
"""
