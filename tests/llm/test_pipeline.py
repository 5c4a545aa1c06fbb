import collections

import corpus_pipeline as pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docquarry.llm import lines, toxicity
from llm import test_minhash as by_set
from llm.conftest import SCHEMA

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def bag(df):
    return collections.Counter(tuple(r) for r in df.collect())


def odd(make):
    return make([(None, None, None), (1, None), (2, ""), (3, "a\nb"), (3, "a\nb"), (None, "x y"), (4, "w " * 30000)])


@pytest.mark.parametrize("turn", range(5))
def test_odd_and_no_rows(spark, make, turn):
    name, stage = pipeline.STAGES[turn]
    for frame in (odd(make).withColumn("k", F.lit(1)).withColumn("score", F.lit(9)), make([(1, "a")]).limit(0)):
        out = stage(spark, frame, FOLDER)
        rows = out.collect()
        if name != "encoding":
            assert out.columns == pipeline.COLUMNS
        if name in ("toxicity", "line_dedup", "encoding"):
            assert len(rows) == frame.count()


def test_toxic_documents_go(spark, docs):
    out = pipeline.drop_toxic(spark, docs, FOLDER)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    said = toxicity.toxicity(docs, labels).where("predicted = 0").select("doc_id")
    assert bag(out) == bag(docs.join(said, "doc_id", "left_semi").select(pipeline.COLUMNS))


def test_the_line_stage_removes_what_the_query_removes(spark, docs):
    own = {(r.doc_id, r.kept_text) for r in lines.remove_repeats(docs, text=True, whole=True).collect()}
    got = pipeline.drop_lines(spark, docs, FOLDER).collect()
    assert {(r.doc_id, r.text) for r in got} == own and len(got) == docs.count()
    assert all(r.n_chars == len(r.text) for r in got)


def test_near_copies(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = {i for i, _, _, k in by_set.brute(rows, 5) if k}
    assert bag(pipeline.drop_near_copies(spark, docs, FOLDER)) == bag(
        docs.where(F.col("doc_id").isin(*kept)).select(pipeline.COLUMNS))


def test_mix(spark, docs):
    from docquarry.llm import mixing
    copies = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    out = bag(pipeline.mix_sources(spark, docs, FOLDER))
    assert out == collections.Counter({tuple(r): copies[r.doc_id] for r in docs.select(pipeline.COLUMNS).collect()
                                       if copies[r.doc_id]})


def test_run_counts_tokens_of_what_is_kept(spark, docs):
    frame = docs
    for _, stage in pipeline.STAGES[:-1]:
        frame = spark.createDataFrame(stage(spark, frame, FOLDER).collect(), SCHEMA)
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = collections.Counter((r.doc_id, len(t.encode(r.text or "", add_special_tokens=False).ids))
                                   for r in frame.collect())
    assert bag(pipeline.run(spark, FOLDER).select("doc_id", "n_tokens")) == expected
