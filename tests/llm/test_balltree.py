import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from docquarry.llm import balltree


def brute(rows, k, every):
    good = [(i, [math.floor(Fraction(x) * 1024) for x in v]) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, q) in enumerate(good):
        if i is None or i % every:
            continue
        scores = sorted((-sum(a * b for a, b in zip(q, c)), j is None, j or 0, j)
                        for m, (j, c) in enumerate(good) if m != n and len(c) == len(q))
        out += [(i, r + 1, j, min(max(-s, -(1 << 63)), (1 << 63) - 1)) for r, (s, _, _, j) in enumerate(scores[:k])]
    return sorted(out, key=repr)


def run(spark, rows, **args):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = balltree.top_k(frame.withColumn("row", F.lit(1)).withColumn("least", F.lit(1)), **args)
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("shard,leaf", [(40, 3), (8192, 48)])
def test_equals_brute_force(spark, monkeypatch, shard, leaf):
    monkeypatch.setattr(balltree, "SHARD", shard)
    monkeypatch.setattr(balltree, "LEAF", leaf)
    monkeypatch.setattr(balltree, "BLOCK", 7)
    rng = random.Random(shard)
    rows = [(i, [rng.choice([0.0, rng.gauss(0, 0.2)]) for _ in range(6)]) for i in range(240)]
    rows += [(1000 + i, [0.25] * 6) for i in range(50)]  # equal vectors: ties by id
    rows += [(2000, None), (2010, [0.1, None, 0.0, 0.0, 0.0, 0.0]), (2020, [math.nan] * 6), (2030, [math.inf] * 6),
             (2040, [1.0, 2.0]), (2050, [-1.0, 0.5]), (2060, []), (2070, []), (None, [0.3] * 6), (2080, [1e300] * 6)]
    assert run(spark, rows, k=5, every=10) == brute(rows, 5, 10)


def test_repeated_rows_few_rows_and_none(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [2.0, 0.0])]
    assert run(spark, rows, k=10, every=100) == brute(rows, 10, 100)
    assert run(spark, [(0, [1.0])]) == [] == run(spark, [(5, [1.0]), (6, [1.0])])
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").limit(0)
    assert balltree.top_k(frame).collect() == []


def test_bounds_prune_leaves():
    rng = np.random.default_rng(1)
    centers = rng.integers(-900, 900, (20, 8))
    points = np.repeat(centers, 100, axis=0) + rng.integers(-5, 5, (2000, 8))
    tree = balltree.Tree(points, np.arange(2000), np.arange(2000))
    seen = []
    real = balltree.heapq.heappop
    balltree.heapq.heappop = lambda h: seen.append(1) or real(h)
    try:
        tree.search(points[:5], np.arange(5), 10, np.full(5, -np.inf))
    finally:
        balltree.heapq.heappop = real
    assert len(seen) < 5 * len(tree.nodes) / 3


@pytest.mark.parametrize("leaf", [2, 48])
def test_components_of_any_size(spark, monkeypatch, leaf):
    """Nothing finite is left out, and scores beyond 64 bits rank exactly."""
    monkeypatch.setattr(balltree, "SHARD", 20)
    monkeypatch.setattr(balltree, "LEAF", leaf)
    rng = random.Random(leaf)
    assert run(spark, [(0, [4e9, 1.0]), (1, [4e9, 2.0]), (2, [5e9, 0.0])]) == brute(
        [(0, [4e9, 1.0]), (1, [4e9, 2.0]), (2, [5e9, 0.0])], 10, 100)
    sizes = [1.0, 3e6, 4e9, 1e15, 1e17, 1e30, 1e160, 1.7e308]
    rows = [(i, [rng.choice([-1, 1]) * rng.random() * rng.choice(sizes) for _ in range(3)]) for i in range(80)]
    rows += [(100 + i, [2.0 ** 52 + i, -(2.0 ** 52), 1.0]) for i in range(12)]
    assert run(spark, rows, k=6, every=5) == brute(rows, 6, 5)


def test_integers_in_order():
    values = [0, 1, -1, 255, 256, -255, -256, 1 << 63, -(1 << 63), 1 << 2200, -(1 << 2200), 7, -7]
    assert sorted(values, key=balltree.in_order) == sorted(values)
