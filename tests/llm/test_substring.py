import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from docquarry.llm import substring
from llm.conftest import rows_of


def brute(rows, n):
    """By dictionaries over all windows."""
    words = [(NO if i is None else i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    least = {}
    for k, w in words:
        for j in range(len(w) - n + 1):
            key = tuple(w[j:j + n])
            least[key] = min(least.get(key, NO), k)
    out = []
    for (i, _), (k, w) in zip(rows, words):
        gone = set()
        for j in range(len(w) - n + 1):
            if least[tuple(w[j:j + n])] < k:
                gone.update(range(j, j + n))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


NO = 1 << 63


def corpus(seed, docs=60):
    rng = random.Random(seed)
    shared = [" ".join(rng.choice("ab cd é x.".split()) + str(rng.randrange(30)) for _ in range(40))
              for _ in range(4)]
    rows = []
    for i in range(docs):
        parts = [rng.choice(shared + [" ".join(str(rng.random()) for _ in range(rng.randrange(30)))])
                 for _ in range(rng.randrange(4))]
        rows.append((rng.randrange(10 ** 12), " \t".join(parts)))
    return rows + [(None, shared[0]), (None, shared[0]), (5, None), (6, ""), rows[3], (7, shared[1]),
                   (-4, shared[2] + "\n" + shared[2]), (8, "w " * 5000), (9, "w " * 40)]


@pytest.mark.parametrize("n,bits", [(13, 20), (13, 9), (3, 20), (1, 20)])
def test_equals_brute_force(make, n, bits):
    """At 2^9 counters nearly all windows pass the filter; the result is the same."""
    rows = corpus(n)
    got = substring.remove_repeats(make(rows).withColumn("starts", F.lit(1)), n, bits=bits)
    assert rows_of(got) == brute(rows, n)


def test_one_passage_in_a_third_of_all_rows(make):
    rows = [(i, ("x y z " * 6 if i % 3 == 0 else "") + f"own {i} text") for i in range(600)]
    assert rows_of(substring.remove_repeats(make(rows, 8), bits=20)) == brute(rows, 13)


def test_small_holds_and_kept_text(make, monkeypatch):
    rows = corpus(77)
    assert substring.remove_repeats(make(rows).limit(0), bits=20).collect() == []
    for r in substring.remove_repeats(make(rows), bits=20, text=True).collect():
        assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256
