import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docquarry.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    doc_id, text, lang, source, n_chars = row
    n_chars = None if n_chars is None else n_chars + more
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def climb(level, fan):
    """Root of the digests and, for each, the siblings of every level with their side."""
    paths, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for path, i in zip(paths, at):
            first = i - i % fan
            path.append((level[first:i], level[i + 1:first + fan]))
        level = [H(*level[i:i + fan]) for i in range(0, len(level), fan)]
        at = [i // fan for i in at]
    return level[0], paths


def brute(rows, fan=2):
    runs = {}
    for row in rows:
        runs.setdefault(row[2], []).append(row)
    names = sorted(runs, key=lambda n: (n is not None, (n or "").encode()))
    own, subroots = {}, []
    for name in names:
        runs[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        root, own[name] = climb([leaf(r) for r in runs[name]], fan)
        subroots.append(root)
    if not names:
        return Counter()
    root, over = climb(subroots, fan)
    out = Counter()
    for name, subroot, above in zip(names, subroots, over):
        for row, path in zip(runs[name], own[name]):
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            fold = leaf(row, 1) if hit else leaf(row)
            for left, right in path + above:
                fold = H(*left, fold, *right)
            proof = H(*[d for left, right in path + above for d in left + right])
            out[row[0], leaf(row), subroot, root, proof, fold, fold == root] += 1
    return out


def run(spark, rows, **args):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    docs = docs.withColumn("idx", F.lit("x")).withColumn("tree", F.lit(1)).withColumn("path", F.lit(1))
    return Counter(tuple(r) for r in merkle.verified_manifest(docs, **args).collect())


def rows_of(n):
    langs = ["en", "en", "en", "de", None, "", "Zé", "ü"]
    rows = [(i * 3 % 101, f"text {i}", langs[i % 8], f"s{i % 3}", i if i % 4 else None) for i in range(n)]
    return rows + [(None, None, None, None, None), (None, "", "en", None, 1), (5, "a", "en", "s", 1), (5, "b", "en", "s", 1),
                   (14, "same", "en", "s", 4), (14, "same", "en", "s", 4), (14, "same", "en", "s", 4),
                   (-3, "x" * 50_000, "one", "s", (1 << 63) - 1)]


@pytest.mark.parametrize("fan", [2, 3])
def test_equals_brute_force(spark, fan):
    rows = rows_of(60)
    got = run(spark, rows, fan=fan)
    assert got == brute(rows, fan)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_one_run_one_row_and_none(spark):
    one = [(7, "a", "en", "s", 1)]
    assert run(spark, one) == brute(one)
    many = [(i, "a", "en", "s", 1) for i in range(5)]
    assert run(spark, many) == brute(many)
    assert run(spark, []) == Counter()
    with pytest.raises(ValueError):
        run(spark, one, fan=1)


def test_places_over_many_ranges(spark):
    rows = spark.createDataFrame([(i * 7 % 500, "k") for i in range(500)] + [(3, "k")] * 200, "v long, w string")
    got = merkle.numbered(rows.repartition(5), [F.col("v")], "t").collect()
    assert sorted(r["place"] for r in got) == list(range(700))
    assert [r["v"] for r in sorted(got, key=lambda r: r["place"])] == sorted(r["v"] for r in got)
