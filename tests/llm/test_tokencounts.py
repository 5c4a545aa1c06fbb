import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from docquarry.llm import tokencounts

WORDS = public_tokenizers.path("word_bpe_49k.json")


def brute(path, texts):
    if path.endswith(".model"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return [len(model.encode(t)) for t in texts]
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    return [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def texts():
    rng = random.Random(12)
    parts = ["The", "the", "the,", "it's", "'tis", "don't.", "I'll!", "x.y", "a,'s", "1,000", "é.", "é", "Å.",
             ".̸", "…", "….", "<|endoftext|>", "a<|endoftext|>b", "<|startoftext|>.", "<|end", "ΣΑΣ", "İstanbul", "漢字。",
             "word word", " ", "\x0b", "\x1c", "\u0085", "👍🏽", "ſt", "ﬁ", "a" * 15, "b" * 16, "c" * 40 + ",", "?!?!", ":;", "''s"]
    out = ["".join(rng.choice(parts) + rng.choice(["", " ", "\n", "\t ", "  "]) for _ in range(rng.randrange(60)))
           for _ in range(120)]
    return out + ["", " ", "word " * 5000, "z" * 30_000, "end.", "́ start"]


def run(docs, path=WORDS, **args):
    return {r[0]: tuple(r)[1:] for r in tokencounts.count_tokens(docs, path, **args).collect()}


@pytest.mark.parametrize("small", [False, True])
def test_equals_the_tokenizer(spark, make, monkeypatch, small):
    """Also with a table, summaries and a cache of a few entries."""
    if small:
        for name, size in (("ENTRIES", 5), ("SUMMARY", 7), ("CACHED", 4), ("FAN", 2)):
            monkeypatch.setattr(tokencounts, name, size)
    whole = texts()
    docs = make([*enumerate(whole), (None, "no id"), (1000, None)], 9).withColumn("n_tokens", F.lit("clash"))
    got = run(docs)
    expected = {i: (len(t.encode()), n, n > 2048) for (i, t), n in zip(enumerate(whole), brute(WORDS, whole))}
    assert got == {**expected, None: (5, 2, False), 1000: (0, 0, False)}


def test_other_tokenizers_take_whole_texts(spark, make):
    whole = [t for t in texts() if len(t) < 5000]
    model = public_tokenizers.path("piece_bpe_32k.model")
    got = run(make([*enumerate(whole), (-1, None)]), model, limit=3)
    assert got == {**{i: (len(t.encode()), n, n > 3) for (i, t), n in zip(enumerate(whole), brute(model, whole))},
                   -1: (0, 0, False)}
    assert tokencounts.lengths_of(public_tokenizers.path("byte_bpe_50k.json")).whole
    assert not tokencounts.lengths_of(WORDS).whole


def test_no_rows_and_repeated_rows(spark, make):
    docs = make([(1, "one two"), (1, "one two"), (1, "one")])
    assert sorted(tuple(r) for r in tokencounts.count_tokens(docs, WORDS).collect()) == [
        (1, 3, 1, False), (1, 7, 2, False), (1, 7, 2, False)]
    assert tokencounts.count_tokens(docs.limit(0), WORDS).collect() == []


def test_frequent_words_are_found_over_all_parts(spark, make):
    rows = [(i, " ".join([f"rare{i}x{j}" for j in range(30)] + ["common", "also"])) for i in range(60)]
    low, high = tokencounts.frequent(make(rows, 8), "text", True, 2)
    assert {tokencounts.spelled(a, b) for a, b in zip(low.tolist(), high.tolist())} == {b"common", b"also"}


def test_summary_is_low_by_a_bound():
    rng = np.random.default_rng(3)
    low = rng.zipf(1.5, 5000).astype(np.uint64)
    held = tokencounts.kept(low, low, np.ones(len(low), np.int64), 20)
    real = dict(zip(*np.unique(low, return_counts=True)))
    assert len(held[0]) <= 20
    for key, count in zip(held[0], held[2]):
        assert real[key] - 5000 // 20 <= count <= real[key]
    assert all(key in held[0] for key, count in real.items() if count > 5000 // 20)


def test_table_finds_exactly_its_keys():
    words = [f"w{i}".encode() for i in range(3000)] + [b"a\x00", b"a"]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    low, high = tokencounts.keys(data, ends - [len(w) for w in words], ends)
    table = tokencounts.Table(low[::2], high[::2], np.arange(len(low[::2]), dtype=np.uint16))
    found = table.find(low, high)
    assert (found[::2] == np.arange(len(found[::2]))).all() and (found[1::2] == -1).all()


def test_units_cover_all_words():
    data = np.frombuffer(b"ab, c.d\n\ne'f ", np.uint8)
    starts, ends, rows = tokencounts.units(data, np.array([0, 4, 13]), True)
    assert [bytes(data[a:b]) for a, b in zip(starts, ends)] == [b"ab", b",", b"c", b".", b"d", b"e'f"]
    assert rows.tolist() == [0, 0, 1, 1, 1, 1]
    assert pa.array([len(r) for r in tokencounts.units(data[:0], np.array([0, 0]), True)]).to_pylist() == [0, 0, 0]
