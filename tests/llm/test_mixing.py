import random

import pytest
from pyspark.sql import functions as F

from docquarry.llm import mixing
from llm.conftest import rows_of


def shares(sizes):
    """Targets by filling up round after round."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] if None in sizes else []
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    out, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 3 * sizes[s]}
        if not over:
            out.update({s: left * weight[s] / total for s in open_})
            break
        out.update({s: 3.0 * sizes[s] for s in over})
        left -= sum(3 * sizes[s] for s in over)
        open_ -= over
    return out


def corpus(seed, n=400):
    rng = random.Random(seed)
    names = ["a", "b", "é", "Z", None, "tiny", "empty"]
    rows = [(i, " ".join("w" for _ in range(int(rng.expovariate(1 / 60)))), rng.choices(names, [9, 5, 5, 3, 2, .1, 0])[0])
            for i in range(n)]
    return rows + [(None, "no id", "a"), (n, None, "a"), (n + 1, "", "empty"), rows[0], (n + 2, "w " * 3000, "b")]


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_limits_and_reruns(make, seed):
    rows = corpus(seed)
    frame = make(rows).withColumn("size", F.lit("x")).withColumn("rank", F.lit(1))
    got = mixing.mix(frame).collect()
    assert len(got) == len(rows)
    by_source = {}
    for i, t, s in rows:
        by_source.setdefault(s, []).append((i, len((t or "").split())))
    sizes = {s: sum(n for _, n in own) for s, own in by_source.items()}
    target = shares(sizes)
    taken = {}
    for r in got:
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 3
    ids = {i: s for i, _, s in rows}
    for r in got:
        s = ids[r.doc_id]
        assert (r.source_size, r.target) == (sizes[s], pytest.approx(target[s]))
        taken[s] = taken.get(s, 0) + r.taken
    for s, own in by_source.items():
        largest = max(n for _, n in own)
        assert abs(taken[s] - target[s]) <= max(1, largest / 2), s
        assert len({r.copies for r in got if ids[r.doc_id] == s}) <= 2 + 1
    assert rows_of(mixing.mix(make(rows, 7))) == rows_of(mixing.mix(make(rows, 2)))


def test_inclusion_follows_the_probability(make):
    """Over many small documents the share that gets one more copy is the fraction wanted."""
    rows = [(i, "a b c", f"s{i % 3}") for i in range(3000)]
    got = mixing.mix(make(rows)).collect()
    for s, wanted in zip(range(3), (0.5, 1.0, 1.5)):
        own = [r.copies for r in got if r.doc_id % 3 == s]
        assert sum(own) / len(own) == pytest.approx(wanted, abs=0.01) and set(own) <= {int(wanted), int(wanted) + 1}


def test_no_words_and_no_rows(make):
    assert {(r.target, r.taken) for r in mixing.mix(make([(1, None), (2, " ")])).collect()} == {(0.0, 0)}
    assert mixing.mix(make([(1, "a")]).limit(0)).collect() == []
