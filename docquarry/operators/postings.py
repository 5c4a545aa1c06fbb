"""Stored postings: ranking by BM25 that reads the query's own terms, and of them only what can
reach the page.

``build`` writes one row a term and document, in segments: each task writes those of its own
documents, grouped by a hash of the term and sorted by term and impact.  A small table of blocks
has, for each term and impact level, how many postings there are and their highest impact.  Impact
is the part of the BM25 score that doesn't depend on the query.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from math import log
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.functions.analysis import Analyzer
from docquarry.functions.fields import FieldScope
from docquarry.functions.predicates import any_of, required_matches
from docquarry.operators.ranking import B, K1
from docquarry.operators.search import ID

#: Folders that terms are dealt to, and impact levels for each unit of impact.
PARTS, LEVELS = 64, 64
#: Postings that are looked at first, for each hit wanted.
SEEDS = 8
#: Room for rounding in bounds.
SLACK = 1e-9
#: Words that are counted at once; a longer text is counted alone.
RUN = 1 << 21

_POSTING = "term string, key {}, __row long, tf int, length int, level int, part int"


@dataclass(frozen=True)
class Block:
    """Postings of one term and impact level: their number and highest impact."""

    level: int
    size: int
    top: float


@dataclass(frozen=True)
class Term:
    word: str
    idf: float
    blocks: tuple[Block, ...]  # highest level first

    @property
    def top(self) -> float:
        return self.idf * self.blocks[0].top

    def level_of(self, size: int) -> int:
        """Highest level above which at least ``size`` postings lie, or the lowest there is."""
        seen = 0
        for block in self.blocks:
            seen += block.size
            if seen >= size:
                break
        return block.level

    def level_reaching(self, score: float) -> int | None:
        """Lowest level with a posting worth ``score``; None if there is none."""
        kept = [b.level for b in self.blocks if self.idf * b.top >= score]
        return min(kept) if kept else None


def _part(word: Column) -> Column:
    return F.pmod(F.crc32(word.cast("binary")), F.lit(PARTS)).cast("int")


def _weight(tf, length, mean):
    """Impact of columns, or of arrays."""
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))


def _counted(mean: float):
    """Postings of batches of documents, sorted by part, term and level in runs of some documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column("length")).astype(np.int64)
            total, at = np.r_[0, np.cumsum(sizes)], 0
            while at < len(sizes):
                end = max(at + 1, int(np.searchsorted(total, total[at] + RUN, "right")) - 1)
                yield from _run_of(batch.slice(at, end - at), sizes[at:end])
                at = end

    def _run_of(batch: pa.RecordBatch, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
        coded = batch.column("words").flatten().dictionary_encode()
        if not len(coded):
            return
        terms = coded.dictionary.to_pylist()
        parts = [crc32(t.encode()) % PARTS for t in terms]
        order = sorted(range(len(terms)), key=lambda i: (parts[i], terms[i]))
        rank = np.empty(len(terms), np.int64)
        rank[order] = np.arange(len(terms))
        seen, tf = np.unique(rank[np.asarray(coded.indices)] << 32 | np.repeat(np.arange(len(sizes)), sizes),
                             return_counts=True)
        rank, doc = seen >> 32, seen & 0xFFFFFFFF
        level = np.floor(_weight(tf.astype(float), sizes[doc], mean) * LEVELS).astype(np.int32)
        sort = np.lexsort((-level, rank))
        rank, doc, tf, level = rank[sort], doc[sort], tf[sort], level[sort]
        term = np.asarray(order, np.int32)[rank]
        for i in range(0, len(sort), RUN // 8):
            some = slice(i, i + RUN // 8)
            docs = pa.array(doc[some])
            yield pa.RecordBatch.from_arrays(
                [coded.dictionary.take(pa.array(term[some])), batch.column("key").take(docs),
                 batch.column("__row").take(docs), pa.array(tf[some].astype(np.int32)),
                 pa.array(sizes[doc[some]].astype(np.int32)), pa.array(level[some]),
                 pa.array(np.asarray(parts, np.int32)[term[some]])],
                ["term", "key", "__row", "tf", "length", "level", "part"])

    return run


def build(df: DataFrame, field: str, folder: str, *, key: str = ID, fields: FieldScope | None = None) -> Postings:
    """Write the postings of a text field below ``folder``.

    A first pass counts documents and their words.  In a second one each task counts the terms of
    its documents, sorts and writes them: no posting is sent to another task, and a word that most
    documents hold is in the segments of all tasks.  Null texts are no documents, empty ones are.
    """
    spark = df.sparkSession
    ref = (fields or FieldScope(df)).field(field)
    if ref.analyzer is None:
        raise TypeError(f"{field!r} is not a text field")
    docs = df.select(F.col(key).alias("key"), F.monotonically_increasing_id().alias("__row"), ref.tokens().alias("words"))
    docs = docs.where("words IS NOT NULL").withColumn("length", F.size("words"))
    docs.agg(F.count(F.lit(1)).alias("docs"), F.avg("length").alias("mean")).coalesce(1).write.parquet(f"{folder}/totals")
    mean = spark.read.parquet(f"{folder}/totals").first()["mean"] or 1.0
    key_type = docs.schema["key"].dataType.simpleString()
    rows = docs.mapInArrow(_counted(mean), _POSTING.format(key_type))
    rows.sortWithinPartitions("part", "term", F.desc("level")).write.partitionBy("part").parquet(f"{folder}/postings")
    stored = spark.read.schema(rows.schema).parquet(f"{folder}/postings")
    impact = _weight(F.col("tf").cast("double"), F.col("length"), F.lit(mean))
    (stored.groupBy("part", "term", "level").agg(F.count(F.lit(1)).alias("size"), F.max(impact).alias("top"))
     .repartitionByRange("part", "term").sortWithinPartitions("part", "term")
     .write.partitionBy("part").parquet(f"{folder}/blocks"))
    return Postings(spark, folder, ref.search_analyzer, key_type, key)


@dataclass(frozen=True)
class Postings:
    """Postings that :func:`build` has written, searched with ``analyzer``."""

    spark: SparkSession
    folder: str
    analyzer: Analyzer
    key_type: str
    key: str = ID

    def _read(self, table: str) -> DataFrame:
        columns = {"totals": "docs long, mean double", "blocks": "term string, level int, size long, top double, part int",
                   "postings": _POSTING.format(self.key_type)}[table]
        return self.spark.read.schema(columns).parquet(f"{self.folder}/{table}")

    def _own(self, word: str) -> Column:
        return (F.col("part") == _part(F.lit(word))) & (F.col("term") == F.lit(word))

    def terms(self, words: Iterable[str]) -> tuple[list[Term], float]:
        """Blocks of the words that occur, and the mean length: a few rows a word."""
        words = list(words)
        docs, mean = self._read("totals").first()
        found: dict[str, list[Block]] = {}
        if words:
            for r in self._read("blocks").where(any_of(map(self._own, words))).collect():
                found.setdefault(r["term"], []).append(Block(r["level"], r["size"], r["top"]))
        out = []
        for word in words:
            if word in found:
                df = sum(b.size for b in found[word])
                blocks = tuple(sorted(found[word], key=lambda b: -b.level))
                out.append(Term(word, log(1 + (docs - df + 0.5) / (df + 0.5)), blocks))
        return out, mean

    def _scores(self, terms: list[Term], levels: dict[str, int], mean: float, need: int, only: DataFrame | None) -> DataFrame:
        """Documents with the sum of their postings from the given levels up."""
        wanted = any_of([self._own(t.word) & (F.col("level") >= levels[t.word]) for t in terms if t.word in levels])
        rows = self._read("postings").where(wanted)
        if only is not None:
            rows = rows.join(only.select(F.col(self.key).alias("key")).distinct(), "key", "left_semi")
        tf, length = F.col("tf").cast("double"), F.col("length")
        worth = lambda t: F.lit(t.idf) * tf * (K1 + 1) / (
            tf + K1 * (1 - B + B * length / F.lit(mean)))
        # A column a term, so that sums don't depend on the order of rows.
        parts = [F.coalesce(F.max(F.when(F.col("term") == t.word, worth(t))), F.lit(0.0)) for t in terms]
        grouped = rows.groupBy("__row").agg(F.first("key").alias(self.key), F.count(F.lit(1)).alias("__met"),
                                          reduce(lambda a, b: a + b, parts).alias("_score"))
        return grouped.where(F.col("__met") >= need).select(self.key, "_score")

    def plan(self, value: str, size: int, operator: str = "OR", minimum_should_match: int | str | None = None,
             only: DataFrame | None = None) -> tuple[list[Term], dict[str, int], float, int]:
        """Terms, the lowest level of each that can reach the best ``size`` hits, mean length and
        number of terms needed.

        The first postings of each term give scores that ``size`` documents reach for sure.
        A posting worth less than that, less the most that all other terms can add, belongs
        to no hit; all postings of a hit are worth more, so its score is whole.
        """
        words = list(dict.fromkeys(self.analyzer.split(value)))
        need = (len(words) if operator.upper() == "AND" else
                1 if minimum_should_match is None else max(required_matches(minimum_should_match, len(words)), 1))
        terms, mean = self.terms(words)
        if len(terms) < need or not terms:
            return [], {}, mean, need
        seeds = {t.word: t.level_of(SEEDS * size) for t in terms}
        best = self._scores(terms, seeds, mean, need, only).orderBy(F.desc("_score")).limit(size)
        reached = best.agg(F.count(F.lit(1)), F.min("_score")).first()
        least = reached[1] * (1 - SLACK) if reached[0] == size else 0.0
        total = sum(t.top for t in terms)
        levels = {t.word: t.level_reaching(least - (total - t.top) * (1 + SLACK)) for t in terms}
        return terms, {w: level for w, level in levels.items() if level is not None}, mean, need

    def rank(self, value: str, *, size: int = 10, from_: int = 0, boost: float = 1.0, operator: str = "OR",
             minimum_should_match: int | str | None = None, only: DataFrame | None = None) -> DataFrame:
        """One page of ``key`` and ``_score``, best first, ties by key; as ``ranking.rank`` with one
        ``scored_match``.  ``only`` holds the keys that may be hits; statistics are those of all."""
        terms, levels, mean, need = self.plan(value, from_ + size, operator, minimum_should_match, only)
        if not levels:
            key = self._read("postings").select(F.col("key").alias(self.key)).limit(0)
            return key.withColumn("_score", F.lit(0.0))
        hits = self._scores(terms, levels, mean, need, only).withColumn("_score", F.lit(float(boost)) * F.col("_score"))
        hits = hits.orderBy(F.desc("_score"), F.asc(self.key))
        return (hits.offset(from_) if from_ else hits).limit(size)
