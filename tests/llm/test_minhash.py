import random
import re

import numpy as np
import pytest

from docquarry.llm import minhash
from docquarry.llm.components import components
from llm.conftest import rows_of


def sets_of(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows, n, percent=80):
    ids = [i for i, _ in rows]
    sets = [sets_of(t, n) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            union = len(sets[i] | sets[j])
            if (sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * union
                    or ids[i] is not None and ids[i] == ids[j] and sets[i] and sets[j]):
                up[top(i)] = top(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return sorted(((d, len(s), least.get(top(i)), d == least.get(top(i)))
                   for i, (d, s) in enumerate(zip(ids, sets))), key=repr)


def corpus(seed, groups=12):
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{rng.randrange(200)}" for _ in range(rng.choice([2, 5, 40, 90]))]
        for _ in range(rng.randrange(1, 14)):
            words = list(base)
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10 ** 6)}"
            rows.append((rng.randrange(10 ** 9), " ".join(words).replace("w1", rng.choice(["w1", "W1"]))))
    return rows + [(None, rows[0][1]), (None, "lonely text without id here"), (1, None), (2, " \n"),
                   rows[5], (rows[7][0], "another text of the same id"), (3, "one"), (4, "One"), (5, "two")]


@pytest.mark.parametrize("seed,n", [(1, 4), (2, 5), (3, 1)])
def test_equals_brute_force(make, seed, n):
    rows = corpus(seed)
    assert rows_of(minhash.near_duplicates(make(rows), n)) == brute(rows, n)


def test_a_chain_of_edits_is_one_component(make):
    """Neighbours are similar, the ends are not: no link may get lost."""
    words = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(40):
        rows.append((1000 - i, " ".join(words)))
        words[(i * 37) % 150] = f"n{i}"
        words[(i * 37 + 1) % 150] = f"m{i}"
    assert rows_of(minhash.near_duplicates(make(rows), 4)) == brute(rows, 4)


def test_groups_in_blocks(make, monkeypatch):
    """Members around a center, many too far from it: compared block by block."""
    monkeypatch.setattr(minhash, "BLOCK", 20_000)
    rng, base, rows = random.Random(4), [f"w{i}" for i in range(120)], []
    for i in range(90):
        words = list(base) if i % 3 else list(rows[-1][1].split()) if rows else list(base)
        for _ in range(rng.randrange(1, 9)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10 ** 6)}"
        rows.append((rng.randrange(10 ** 6), " ".join(words)))
    assert rows_of(minhash.near_duplicates(make(rows), 4)) == brute(rows, 4)


def test_empty_table(make):
    assert minhash.near_duplicates(make([(1, "a")]).limit(0)).collect() == []


def test_sketches_estimate_similarity_and_fill():
    rng = np.random.default_rng(5)
    for size in (1, 3, 50, 3000):
        items = rng.integers(0, 1 << 63, 2 * size, np.uint64)
        a, b = np.sort(items[:size + size // 2]), np.sort(items[size // 2:])
        got = minhash.sketches(np.repeat([0, 1], [len(a), len(b)]), np.concatenate([a, b]), 2)
        assert (got != np.iinfo(np.uint64).max).all()
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((got[0] == got[1]).mean() - true) < 0.2


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(0, 60) if i % 20] + [(100, rng.randrange(101, 140)) for _ in range(30)]
    links += [(9, 9), (5, 4), (4, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    for i in range(1, 60):
        assert got.get(i, i) == i if i % 20 == 1 else got[i] == i - (i - 1) % 20
    assert all(got[b] == 100 for a, b in links if a == 100)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
