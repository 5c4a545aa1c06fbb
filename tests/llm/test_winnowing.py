import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from docquarry.llm import winnowing
from llm.conftest import rows_of


def marks_of(spark, texts, gram=3, window=8):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: [(m.hash, m.place) for m in r.marks]
            for r in winnowing.fingerprints(frame, gram=gram, window=window).collect()}


def brute(hashed, window):
    """Places of the smallest hash of each window, the rightmost of equal ones."""
    windows = [range(i, i + window) for i in range(len(hashed) - window + 1)] or [range(len(hashed))]
    return sorted({max((-hashed[i], i) for i in w)[1] for w in windows if len(w)})


@pytest.mark.parametrize("gram,window", [(3, 8), (1, 4), (2, 1)])
def test_marks_are_the_minima_of_all_windows(spark, gram, window):
    rng = random.Random(gram)
    texts = [" ".join(rng.choice("a b c dd é".split()) for _ in range(rng.randrange(60))) for _ in range(40)]
    # With windows of one gram every gram is a mark: that shows the hashes.
    all_, got = marks_of(spark, texts, gram, 1), marks_of(spark, texts, gram, window)
    for i, text in enumerate(texts):
        hashed = [h for h, _ in sorted(all_[i], key=lambda m: m[1])]
        words = len(text.split())
        assert len(hashed) == (max(1, words - gram + 1) if words else 0)
        assert [p for _, p in sorted(got[i], key=lambda m: m[1])] == brute(hashed, window)
        assert all(hashed[p] == h for h, p in got[i])


def test_shared_runs_share_a_mark(spark):
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(10 ** 6)}"
    texts = []
    for _ in range(30):
        run = [word() for _ in range(winnowing.GRAM + winnowing.WINDOW - 1)]
        for _ in range(2):
            texts.append(" ".join([word() for _ in range(rng.randrange(40))] + run
                                  + [word() for _ in range(rng.randrange(40))]))
    got = marks_of(spark, texts)
    assert all({h for h, _ in got[i]} & {h for h, _ in got[i + 1]} for i in range(0, 60, 2))


def test_edited_texts(make, spark):
    rng = random.Random(2)
    rows = [(rng.randrange(-10 ** 9, 10 ** 12), "\n".join(
        " ".join(rng.choice("the of ünd a x y z".split()) for _ in range(rng.randrange(1, 30)))
        for _ in range(rng.randrange(6)))) for _ in range(80)]
    rows += [(None, "no id here"), (7, None), (8, ""), (9, "é"), (10, "long " * 20000), (11, rows[0][1])]
    got = winnowing.edited(make(rows + [rows[3]], 5).withColumn("k", F.lit(1)).withColumn("found", F.lit(1)))
    order = sorted(rows, key=lambda r: -r[0] if r[0] is not None else 10 ** 18)
    text = [t or "" for _, t in order]
    changed = [t[:len(t) - len(t) // 3] + text[(i + 1) % len(text)][:len(t) // 3] for i, t in enumerate(text)]
    marks = marks_of(spark, text + changed)
    near = lambda a, b: (len(a & b) / len(a | b)) if a | b else 1.0
    sets = [{h for h, _ in marks[i]} for i in range(2 * len(text))]
    expected = {}
    for i, (k, _) in enumerate(order):
        expected[k] = (len(text[i]), hashlib.sha256(changed[i].encode()).hexdigest(),
                       near(sets[i], sets[len(text) + i]), near(sets[i], sets[(i + 1) % len(text)]))
    collected = got.collect()
    assert len(collected) == len(rows) + 1
    for r in collected:
        assert (r.n_chars, r.edited_sha256) == expected[r.doc_id][:2]
        assert (r.near_edited, r.near_next) == pytest.approx(expected[r.doc_id][2:])
    prints = {}
    for r in collected:
        prints.setdefault(dict(order)[r.doc_id] or "", set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values()) and len({min(p) for p in prints.values()}) > 60


def test_one_and_no_document(make):
    row = winnowing.edited(make([(1, "abc def ghi")])).first()
    assert row.edited_sha256 == hashlib.sha256(b"abc def abc").hexdigest() and row.near_next == 1
    assert winnowing.edited(make([(1, "a")]).limit(0)).collect() == []


def test_no_python(make):
    plan = winnowing.edited(make([(1, "a b")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
