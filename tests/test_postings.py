import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from docquarry.functions.predicates import Fields
from docquarry.operators import postings, ranking


def rounded(df):
    return [(r["_id"], round(r["_score"], 9)) for r in df.collect()]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choices(words, [1 / (n + 1) for n in range(40)], k=rng.randrange(1, 60)))) for i in range(600)]
    rows += [(600, ""), (601, None), (602, "w0 " * 50), (603, "Solo"), (603, "solo twin"), (604, "w0!"), (None, "w0 w1")]
    docs = spark.createDataFrame(rows, "_id int, text string").repartition(5)
    fields = Fields(docs, text=["text"])
    return docs, postings.build(docs, "text", str(tmp_path_factory.mktemp("postings") / "p"), fields=fields)


@pytest.mark.parametrize("text,options", [
    ("w0", {}), ("w0 W1 w39", {}), ("w30 w35", {}), ("w0 w2", {"operator": "AND"}), ("solo", {}), ("w39 missing", {}),
    ("w0 w1 w2 w3", {"minimum_should_match": "75%"}), ("w0 w5", {"boost": 3.0})])
def test_pages_equal_those_of_the_whole_collection(spark, stored, text, options):
    docs, index = stored
    q = Fields(docs, text=["text"])
    for size, from_ in ((1, 0), (7, 0), (20, 5), (1000, 0)):
        expected = ranking.rank(docs, must=[ranking.scored_match(q, "text", text, **options)], size=size, from_=from_)
        assert rounded(index.rank(text, size=size, from_=from_, **options)) == rounded(expected), (size, from_)


def test_only_listed_documents(spark, stored):
    docs, index = stored
    q = Fields(docs, text=["text"])
    expected = ranking.rank(docs, must=[ranking.scored_match(q, "text", "w0 w1")], filter=[F.col("_id") % 7 == 0], size=9)
    only = docs.where("_id % 7 = 0").union(docs.where("_id = 7"))
    assert rounded(index.rank("w0 w1", size=9, only=only)) == rounded(expected)


def test_blocks_that_cannot_reach_the_page_are_skipped(stored):
    _, index = stored
    terms, levels, _, _ = index.plan("w0", 3)
    kept = sum(b.size for t in terms for b in t.blocks if b.level >= levels[t.word])
    assert 3 <= kept < sum(b.size for t in terms for b in t.blocks) / 10
    plan = plan_of(index.rank("w0 w39", size=3))
    assert "regexp" not in plan and "PartitionFilters: [((part" in plan and "GreaterThanOrEqual(level" in plan


def test_nothing_found(spark, stored, tmp_path):
    docs, index = stored
    assert index.rank("missing").collect() == [] == index.rank("...").collect()
    assert index.rank("w0 missing", operator="AND").collect() == []
    none = docs.limit(0)
    empty = postings.build(none, "text", str(tmp_path / "none"), fields=Fields(none, text=["text"]))
    assert empty.rank("w0").columns == ["_id", "_score"] and empty.rank("w0").collect() == []
    with pytest.raises(TypeError):
        postings.build(docs, "_id", str(tmp_path / "x"))


def test_postings_are_written_by_the_task_that_split_the_document(stored):
    """No posting is sent to another task, and those of a segment are sorted by term and level."""
    _, index = stored
    rows = index._read("postings").withColumn("file", F.regexp_extract(F.input_file_name(), "part-([0-9]+)", 1))
    tasks = rows.groupBy("__row").agg(F.count_distinct("file")).collect()
    assert len(tasks) > 600 and {r[1] for r in tasks} == {1}
    segments = {}
    for r in rows.collect():
        segments.setdefault((r.file, r.part), []).append((r.term, -r.level))
    assert len(segments) > 20 and all(s == sorted(s) for s in segments.values())


def test_postings_hold_every_term_of_every_document(spark, stored):
    docs, index = stored
    want = sorted((w, k or -1, t.lower().replace("!", "").split().count(w)) for k, t in docs.collect() if t
                  for w in set(t.lower().replace("!", "").split()))
    assert sorted((r.term, r.key or -1, r.tf) for r in index._read("postings").collect()) == want


def test_batches_are_counted_in_sorted_runs(monkeypatch):
    monkeypatch.setattr(postings, "RUN", 8)
    texts = [["b", "a", "b"], [], ["c"] * 9, ["é", "a"], ["b"], []]
    batch = pa.RecordBatch.from_pylist([{"key": None if i == 3 else i, "__row": 10 + i, "words": w, "length": len(w)}
                                        for i, w in enumerate(texts)])
    runs = [b.to_pylist() for b in postings._counted(2.5)(iter([batch, batch.slice(1, 1)]))]
    order = lambda r: (r["part"], r["term"], -r["level"])
    rows = [r for run in runs for r in run]
    assert len(runs) > 3 and all(run == sorted(run, key=order) for run in runs)
    assert sorted((r["__row"] - 10, r["term"], r["tf"], r["length"]) for r in rows) == sorted(
        (i, t, w.count(t), len(w)) for i, w in enumerate(texts) for t in set(w))
    assert all(r["key"] == (None if r["__row"] == 13 else r["__row"] - 10) for r in rows)
    assert all(r["level"] == int(postings._weight(r["tf"], r["length"], 2.5) * postings.LEVELS) for r in rows)
