import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from docquarry.llm import toxicity

SYMBOL = toxicity._SYMBOL


def word(text):
    return bytes(SYMBOL[b] for b in text.encode() if SYMBOL[b])


def slow(one, two):
    """The kernel by going over all subsequences."""
    def features(w):
        out = {}
        for at in itertools.combinations(range(len(w)), 3):
            if at[2] - at[0] < toxicity.SPAN:
                key = tuple(w[i] for i in at)
                out[key] = out.get(key, 0) + toxicity.DECAY ** (at[2] - at[0] - 2)
        return out
    x, y = features(one), features(two)
    dot = lambda p, q: sum(v * q.get(k, 0) for k, v in p.items())
    return dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5 if x and y else 0


def test_kernel_equals_its_definition():
    words = [word(w) for w in "idiot idxiot stupid stuupid table chair banana bananas üble über".split()]
    kernel = toxicity.Kernel(words)
    data, end = np.frombuffer(b"".join(words), np.uint8), np.cumsum([len(w) for w in words])
    start = end - [len(w) for w in words]
    at, values = kernel.of(data, start, end)
    assert list(at) == list(range(len(words)))
    for i, j in itertools.product(range(len(words)), repeat=2):
        true = slow(words[i], words[j])
        assert values[i, j] == pytest.approx(true ** toxicity.SHARP if true >= toxicity.LEAST else 0, abs=1e-5)
    near = kernel.near(data, start, end)
    assert near[values.any(axis=1)].all()  # the bound drops nothing


def test_words_are_read_through_gaps():
    texts = "a s t u p i d x", "St-up!id", "stu pid"
    for text, expected in zip(texts, (["astupidx"], ["stupid"], ["stu", "pid"])):
        data = np.frombuffer(text.encode(), np.uint8)
        symbol, start, end, _ = toxicity.symbols(data, np.array([0, len(data)]))
        assert [symbol[a:b].tobytes() for a, b in zip(start, end)] == [word(w) for w in expected]


@pytest.fixture(scope="module")
def tables(spark):
    folder = "/root/testdata/sf0.01"
    return (spark.read.parquet(f"{folder}/documents.parquet"),
            spark.read.parquet(f"{folder}/labels.parquet"))


def test_held_out_accuracy(tables):
    docs, labels = tables
    got = toxicity.toxicity(docs, labels).join(labels, "doc_id").toPandas()
    got = got[got.held_out]
    assert list(got.held_out) == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]
    toxic, said = got.toxic == 1, got.predicted == 1
    assert (toxic == said).mean() > 0.9 and (toxic & said).sum() / toxic.sum() > 0.6
    assert set(got.predicted) <= {0, 1} and ((got.score >= 0.3) == said).all()


def test_inserted_letters_and_edge_rows(spark, tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels)
    rows = [(1, "you i d i o t you mor-on"), (2, "Idiiot! stupiid trassh"), (3, "a calm plain sentence"),
            (4, ""), (None, None), (6, "word " * 50000), (6, "word " * 50000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit(1))
    got = toxicity.score(frame, model).collect()
    score = {r.doc_id: r.score for r in got}
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got) and "row" in got[0]
    assert min(score[1], score[2]) > 0.3 > max(score[3], score[4], score[6]) and score[None] == score[4]


def test_without_labels(spark, tables):
    docs, labels = tables
    for few in (labels.limit(0), labels.where("toxic = 0").limit(5), labels.select("doc_id", F.lit(None).cast("int").alias("toxic"))):
        got = toxicity.toxicity(docs.limit(3), few).collect()
        assert len(got) == 3 and len({r.score for r in got}) == 1
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []
