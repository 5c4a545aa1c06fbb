"""From raw documents to encoded training text.

Every stage takes all that its predecessor kept and returns the columns of documents, the
last one token counts and digests.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.llm import bpe, lines, minhash, mixing, toxicity
from docquarry.llm.common import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't call toxic (operator 6).  It learns from the
    labelled documents that aren't held out; all documents are scored alike."""
    docs = docs.select(COLUMNS)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model, into="score").where(
        F.col("score") < toxicity.THRESHOLD).select(COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of two lines and more that an earlier one has (operator 5, as
    its query).  A text that loses nothing, null included, stays as it is; none of the
    documents goes."""
    docs = docs.select(COLUMNS)
    return lines.shortened(docs, whole=True).withColumn(
        "n_chars", F.when(F.col("lines_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    ).select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies (operator 8), by
    shingles of five words as any stage that no contract says otherwise of.  Repeated rows of
    it are one document."""
    docs = docs.select(COLUMNS)
    kept = minhash.near_duplicates(docs, words=5).where("kept").select(F.col("doc_id").alias("id")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi").distinct()


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it (operator 4): a row for each copy."""
    docs = docs.select(COLUMNS)
    taken = mixing.copies(docs).where("copies > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every text (operator 7)."""
    return bpe.encode_documents(docs.select(COLUMNS), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("near_dedup", drop_near_copies),
          ("mixing", mix_sources), ("encoding", encode)]

#: Kernels, sketches and token ids are beyond SQL; the tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents of a folder, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
