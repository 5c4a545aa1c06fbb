import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from docquarry.llm import prefixes

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        whole[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        size = len(node[-1][1]) if node else 0
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = (len(members[node]) - 1) * size + sum(saved[k] for k in kids[node])
        end = ",".join(str(c) for c in sorted(c for c in members[node] if whole[c] == node))
        out.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]),
                    len(kids[node]), leaves[node], saved[node], hashlib.sha256(end.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    frame = frame.withColumn("key", F.lit(1)).withColumn("depth", F.lit("x")).withColumn("path", F.lit(None))
    return sorted((tuple(r) for r in prefixes.conversation_trie(frame).collect()), key=repr)


@pytest.mark.parametrize("pack", [32 << 10, 5])
def test_equals_brute_force(spark, monkeypatch, pack):
    monkeypatch.setattr(prefixes, "PACK", pack)
    rng, rows = random.Random(pack), []
    for c in [*range(0, 320, 3), 100, 200, 1000, 1001, 100_050, -5, -100]:
        style = rng.randrange(4)
        for turn in range(rng.choice([1, 2, 4, 9])):
            text = {0: "same", 1: f"t{turn}", 2: rng.choice("ab"), 3: f"ünï{c}"}[style]
            rows.append((c, turn, ["user", "assistant"][turn % 2], text))
    rows += [(5000, None, None, None), (5000, 1, "user", ""), (5000, 1, "user", "b"), (5000, 1, "user", "a"),
             (5000, 1, "user", "a"), (None, 1, "user", "nobody"), (5001, 0, "user", "x" * 40_000)]
    assert run(spark, rows) == brute(rows)


def test_copies_of_long_conversations_peel_in_few_rounds(spark, monkeypatch):
    """Equal conversations are one sequence: only prefixes of different ones take rounds."""
    named = []
    real = prefixes.stored
    monkeypatch.setattr(prefixes, "stored", lambda df, name: named.append(name) or real(df, name))
    rows = [(c, t, "user", f"turn {t}") for c in range(1, 40) for t in range(60)]
    rows += [(c, t, "user", f"turn {t if t < 3 else c * 100 + t}") for c in range(40, 60) for t in range(30)]
    assert run(spark, rows) == brute(rows)
    rounds = {n for n in named if n[5:].isdigit()}
    assert len(rounds) <= 8


def test_one_turn_and_none(spark):
    assert run(spark, [(7, 0, "user", "hi")]) == brute([(7, 0, "user", "hi")])
    assert run(spark, [(None, 0, "user", "hi")]) == [] == run(spark, [])


def test_general_interface_keeps_keys_of_parents(spark):
    items = spark.createDataFrame([(1, 0, b"a", 2), (2, 0, b"a", 2), (2, 1, b"b", 3)],
                                  "conv_id long, turn int, item binary, size long")
    ids = spark.createDataFrame([(1,), (2,), (3,)], "conv_id long")
    rows = {r["node"]: r for r in prefixes.trie(items, ids).collect()}
    assert sorted((r["depth"], r["conv_id"], r["n_convs"], r["saved_tokens"]) for r in rows.values()) == [
        (0, 1, 3, 2), (1, 1, 2, 2), (2, 2, 1, 0)]
    for r in rows.values():
        assert r["depth"] == 0 or rows[r["parent"]]["conv_id"] == r["parent_conv_id"]
