import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docquarry.llm import lines
from docquarry.llm.common import Hasher, keyed
from llm.conftest import rows_of

NO = (1 << 63) - 1


def cut(text):
    """Chunks of a text: (first line, lines, bytes), from the definition, line by line."""
    if not text:
        return []
    hasher, parts = Hasher(51), text.split("\n")
    raw = [p.encode() for p in parts]
    data = np.frombuffer(b"".join(r + b"\n" for r in raw), np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raw]) - 1
    hashed = hasher.slices(data, ends - [len(r) for r in raw], ends)
    rolled = [int(x >> np.uint64(16)) % lines.MEAN == 0 for x in hasher.windows(hashed, 2)]
    ended = [False, *rolled]  # whether the line and the one before roll to a boundary
    stops = [i + 1 for i in range(len(parts) - 1) if ended[i] and not (i and ended[i - 1])]
    edges = [0, *stops, len(parts)]
    return [(a, b - a, b"\n".join(raw[a:b])) for a, b in zip(edges, edges[1:])
            if b - a > 1 and any(r.split() for r in raw[a:b])]


def brute(rows):
    docs = {}
    for i, t in rows:
        docs[(NO if i is None else i, t or "")] = cut(t)
    keeper = {}
    for (k, t), chunks in docs.items():
        for first, _, chunk in chunks:
            keeper[chunk] = min(keeper.get(chunk, (NO + 1, 0)), (k, first))
    out = []
    for i, t in rows:
        k = NO if i is None else i
        gone = {x for first, n, chunk in docs[(k, t or "")] if keeper[chunk] != (k, first)
                for x in range(first, first + n)}
        parts = (t or "").split("\n") if t else []
        kept = "\n".join(p for j, p in enumerate(parts) if j not in gone)
        out.append((i, len(parts), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    passages = [[f"line {rng.randrange(10 ** 6)} é" for _ in range(12)] for _ in range(3)]
    rows = []
    for i in range(50):
        text = []
        for _ in range(rng.randrange(4)):
            text += rng.choice(passages) if rng.random() < 0.5 else [f"own {rng.random()}" for _ in range(rng.randrange(6))]
        rows.append((rng.randrange(-100, 10 ** 12), "\n".join(text)))
    return rows + [(None, "\n".join(passages[0])), (1, None), (2, ""), (3, "\n\n\n\n"), (4, "\n\n\n\n"), (5, "one line"),
                   (6, "one line"), (7, "a\nb\n" * 3000), rows[1]]


def test_equals_brute_force(make):
    rows = corpus(1)
    got = lines.remove_repeats(make(rows).withColumn("chunk", F.lit(1)).withColumn("h", F.lit(1)))
    assert rows_of(got) == brute(rows)
    assert any(r[2] for r in brute(rows))


def test_shifted_passages_are_cut_alike(make):
    rng = random.Random(5)
    passage = [f"shared {rng.randrange(10 ** 9)}" for _ in range(40)]
    rows = [(i, "\n".join([f"intro {i} {j}" for j in range(i)] + passage)) for i in range(8)]
    got = {r.doc_id: r for r in lines.remove_repeats(make(rows), text=True).collect()}
    # All but the first chunk, whose lines before differ.
    first = cut(rows[0][1])[0][1]
    assert all(got[i].n_removed >= 40 - first for i in range(1, 8)) and got[0].n_removed == 0
    assert got[0].kept_text == rows[0][1]


def test_one_chunk_in_a_third_of_all_rows(make):
    rows = [(i, ("same a\nsame b\nsame c\n" if i % 3 == 0 else "") + f"own {i}\nline {i}") for i in range(400)]
    assert rows_of(lines.remove_repeats(make(rows, 8))) == brute(rows)
    assert lines.remove_repeats(make(rows).limit(0)).collect() == []


def runs_gone(rows):
    """Lines to remove of each row, by a dictionary over all pairs of lines."""
    first, docs = {}, sorted({(NO if i is None else i, t or "") for i, t in rows})
    units = {}
    for k, t in docs:
        parts = t.split("\n") if t else []
        full = [bool(p.encode().split()) for p in parts]
        spans = [(a, a + 2) for a in range(len(parts) - 1) if full[a] or full[a + 1]]
        at = [a for a, x in enumerate(full) if x]
        spans += [(a, b + 1) for a, b in zip(at, at[1:]) if b - a > 3]
        units[k, t] = [(a, b, tuple(parts[a:b])) for a, b in spans]
        for a, _, key in units[k, t]:
            first[key] = min(first.get(key, (NO + 1, "", 0)), (k, t, a))
    return {d: {x for a, b, key in own for x in range(a, b)
                if first[key][:2] != d or a >= first[key][2] + b - a} for d, own in units.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_short_passages_go_whole(make, seed):
    """Passages of 2 to 6 lines and 50 words or more, in different surroundings, lose every line."""
    rng = random.Random(seed)
    own = lambda n: [f"own {rng.random()}" for _ in range(n)]
    passages = [[" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(25)) for _ in range(2 + i % 5)] for i in range(20)]
    rows = [(i, "\n".join([*own(rng.randrange(4)), *p, *own(rng.randrange(4))])) for i, p in enumerate(passages)]
    places = [(100 + i, own(1 + rng.randrange(4)), p, own(1 + rng.randrange(4))) for i, p in enumerate(passages)]
    rows += [(i, "\n".join([*a, *p, *b])) for i, a, p, b in places]
    got = {r.doc_id: r for r in lines.remove_repeats(make(rows), text=True, whole=True).collect()}
    assert all(got[i].kept_text == "\n".join([*a, *b]) for i, a, _, b in places)
    assert all(got[i].n_removed == 0 for i in range(20))


def test_whole_runs_equal_brute_force(make):
    rows = [(k, t) for k, t in {i: (i, t) for i, t in corpus(3)}.values()]
    rows += [(20, "a\na\na"), (21, "p q\n\n\n\n\nr s\nt"), (22, "z\np q\n\n\n\n\nr s\nu"), (23, "\n\nt")]
    expected = runs_gone(rows)
    for r, t in ((r, dict(rows)[r.doc_id]) for r in lines.remove_repeats(make(rows), text=True, whole=True).collect()):
        gone = expected[NO if r.doc_id is None else r.doc_id, t or ""]
        parts = t.split("\n") if t else []
        assert (r.n_removed, r.kept_text) == (
            len(gone), "\n".join(p for j, p in enumerate(parts) if j not in gone)), r


def test_whole_runs_go_by_chunks_first(make):
    """Repeated chunks go as chunks; pairs only add the lines beyond them."""
    rng = random.Random(6)
    passage = [f"shared {rng.randrange(10 ** 9)}" for _ in range(30)]
    rows = [(1, "\n".join(passage)), (2, "\n".join(["own a", "own b", *passage, "own c"]))]
    spans = {(a, n) for a, n, chunk in cut(rows[1][1]) if chunk.decode() in rows[0][1]}
    gone = lines.removals(keyed(make(rows)), whole=True).collect()
    assert len(spans) >= 5 and [r.k for r in gone] == [2]
    found = {(g["first"], g["lines"]) for g in gone[0].gone}
    assert spans <= found
    assert not any(a <= f and f + n <= a + m for f, n in found - spans for a, m in spans)
    assert {x for f, n in found for x in range(f, f + n)} == set(range(2, 32))


def test_bytes_are_compared():
    """Chunks and pairs are held against each other by their bytes, not by digests."""
    text = "\n\n\na b\nc\n\n\n\nd"
    batch = pa.RecordBatch.from_pylist([{"k": 1, "th": 2, "text": text, "wanted": list(range(9))}])
    for kind in ("chunks", "trimmed", "pairs"):
        got = [r for b in lines._units(kind, True)(iter([batch])) for r in b.to_pylist()]
        assert got and all(r["chunk"].decode() == "\n".join(
            text.split("\n")[r["first"]:r["first"] + r["lines"]]) for r in got)


@pytest.mark.parametrize("seed", range(4))
def test_whole_runs_with_white_space_equal_brute_force(make, seed):
    rng = random.Random(seed)
    rows = [(i, "\n".join(rng.choice(["", " ", "a", "b", "c d", "e"]) for _ in range(rng.randrange(30)))) for i in range(60)]
    expected = runs_gone(rows)
    for r in lines.remove_repeats(make(rows), whole=True).collect():
        assert r.n_removed == len(expected[r.doc_id, dict(rows)[r.doc_id]]), r
