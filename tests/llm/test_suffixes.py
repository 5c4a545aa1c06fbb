import hashlib
import random
from functools import partial

import numpy as np
import pyarrow as pa
import pytest
from pyspark import SparkContext
from pyspark.sql import functions as F

from docquarry.llm import prefilter, suffixes
from docquarry.llm.common import buffers, homes, keyed
from llm.conftest import rows_of

NO = 1 << 63


@pytest.mark.parametrize("seed", range(12))
def test_suffix_order(seed):
    """Suffixes come in order of their first 50 items, equal ones in any order."""
    rng = random.Random(seed)
    n, letters = rng.choice([0, 1, 2, 3, 4, 7, 40, 300, 1200]), rng.choice([1, 2, 4, 200])
    text = [rng.randrange(letters) for _ in range(n)]
    if seed % 2 and n > 100:
        text = (text[:n // 3] * 4)[:n]
    order, ranks = suffixes.suffix_order(np.array(text, np.int64), 50)
    assert sorted(order) == list(range(n))
    keys = [text[i:i + 50] for i in order]
    assert keys == sorted(keys)
    assert all(ranks[i] <= ranks[j] for i, j in zip(order, order[1:]))


@pytest.mark.parametrize("n", [1, 5, 8, 9, 50])
def test_classes_of_equal_strings(n):
    rng = np.random.default_rng(n)
    data = rng.integers(97, 99, 600).astype(np.uint8)
    data[300:420] = data[:120]
    starts = np.arange(0, 600 - n + 1)
    got = suffixes.repeats_at(data, starts, n)
    raw = data.tobytes()
    pairs = {(raw[i:i + n], g) for i, g in zip(starts, got)}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def brute(rows, n):
    raw = [(NO if i is None else i, (t or "").encode()) for i, t in rows]
    least = {}
    for k, t in raw:
        for j in range(len(t) - n + 1):
            least[t[j:j + n]] = min(least.get(t[j:j + n], NO), k)
    out = []
    for (i, _), (k, t) in zip(rows, raw):
        gone = bytearray(len(t))
        for j in range(len(t) - n + 1):
            if least[t[j:j + n]] < k:
                gone[j:j + n] = b"\1" * n
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(g and not (j and gone[j - 1]) for j, g in enumerate(gone))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, docs=70):
    rng = random.Random(seed)
    text = lambda m: "".join(rng.choice("ab é") for _ in range(m))
    shared = [text(rng.choice([30, 60, 200])) for _ in range(6)]
    rows = []
    for _ in range(docs):
        parts = []
        for _ in range(rng.randrange(5)):
            piece = rng.choice(shared + [text(rng.randrange(80))])
            if rng.random() < 0.4:  # cut or changed in the middle
                at = rng.randrange(len(piece) + 1)
                piece = rng.choice([piece[at:], piece[:at], piece[:at] + "x" + piece[at:]])
            parts.append(piece)
        rows.append((rng.randrange(-5, 10 ** 12), "".join(parts)))
    return rows + [(None, shared[0] * 3), (None, shared[0]), (5, None), (6, ""), rows[3], (7, "a" * 400),
                   (8, "b" + "a" * 300), (9, shared[1] + shared[1]), (-9, shared[2])]


@pytest.mark.parametrize("n,bits,seed", [(50, 20, 1), (50, 9, 2), (7, 20, 3), (20, 20, 4), (1, 12, 5)])
def test_equals_brute_force(make, n, bits, seed):
    rows = corpus(seed)
    got = suffixes.remove_repeats(make(rows).withColumn("runs", F.lit(1)).withColumn("bucket", F.lit(1)), n, bits=bits)
    assert rows_of(got) == brute(rows, n)


def test_one_passage_in_a_third_of_all_rows(make, monkeypatch):
    monkeypatch.setattr(suffixes, "HELD", 500)
    rows = [(i, ("the passage that all have, of more than fifty bytes; " if i % 3 == 0 else "") + f"own {i} text")
            for i in range(500)]
    assert rows_of(suffixes.remove_repeats(make(rows, 8), bits=20)) == brute(rows, 50)
    assert suffixes.remove_repeats(make(rows).limit(0), bits=20).collect() == []
    for r in suffixes.remove_repeats(make(rows[:50]), bits=20, kept=True).collect():
        assert hashlib.sha256(r.kept_bytes).hexdigest() == r.kept_sha256


def test_each_group_is_told_the_counters_that_another_id_has_too(make):
    """Of a sketch that grows with the corpus, a group gets its own counters only."""
    own = lambda i: " ".join(f"{i}w{j * 7919}" for j in range(40))
    passage = "a passage of two documents, long enough for a string of fifty bytes; "
    rows = [(i, own(i) + passage * (i < 2)) for i in range(30)]
    rows += [(50, own("x") * 3), (60, own("same row")), (60, own("same row")), (None, own("none")), (None, own("none") + "!")]
    dealt = suffixes._dealt(keyed(make(rows)), homes(4))
    texts, ids = {}, {}
    for r in dealt.collect():
        data, offsets = buffers(pa.array([bytes(r.bytes)]))
        found = set(prefilter.cells(suffixes.Segments(50).anchors(data, offsets)[0], 0, 40).tolist())
        texts.setdefault(r.g, set()).update(found)
        for x in found:
            ids.setdefault(x, set()).add(r.k)
    groups = [x for found in texts.values() for x in found]
    shared = {x for x, k in ids.items() if len(k) > 1 or groups.count(x) > 1}
    got = {}
    for r in prefilter.shared_counters(dealt, partial(suffixes.Segments, 50)).collect():
        got.setdefault(r.g, set()).update(prefilter.unpacked(bytes(r["keys"])).tolist())
    assert shared and len(texts) > 1 and len(shared) < len(ids) / 20
    assert got == {g: found & shared for g, found in texts.items()}


def test_documents_are_shuffled_once_and_nothing_is_broadcast(make, monkeypatch):
    def broadcast(*_):
        raise AssertionError("broadcast")
    monkeypatch.setattr(SparkContext, "broadcast", broadcast)
    rows = corpus(6)
    got = suffixes.remove_repeats(make(rows))
    assert rows_of(got) == brute(rows, 50)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") == 2 and plan.count("Scan ExistingRDD") == 1


@pytest.mark.parametrize("count", [1, 2, 7, 211])
def test_each_partition_has_a_home(spark, count):
    got = spark.createDataFrame([(x,) for x in homes(count)], "g int").select(F.pmod(F.hash("g"), F.lit(count)))
    assert [r[0] for r in got.collect()] == list(range(count))


def test_notes_come_first():
    batch = lambda *kinds: pa.RecordBatch.from_arrays([pa.array(kinds, "i4")], ["kind"])
    assert [(a.num_rows, b.num_rows) for a, b in suffixes._notes([batch(0, 0), batch(0, 1), batch(1)])] == [(2, 0), (1, 1), (0, 1)]
    for wrong in ([batch(1, 0)], [batch(1), batch(0)]):
        with pytest.raises(RuntimeError):
            list(suffixes._notes(wrong))
