import hashlib

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docquarry.llm import bpe
from llm.conftest import rows_of

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", "  ", "A<|endoftext|>b <|ENDOFTEXT|> x", "é éa İİ ß Ǆ 'S don't it's '",
       "  a\tb   c  ", "a" * 5000, "αΣ ΑΣ. ١٢ 12a3 ...) ).", "日本語 テキスト 한국어 🙂🙂 x🙂",
       "one two " * 3000, "x́́ ́y"]


def expected(text):
    t = Tokenizer.from_file(PATH)
    ids = t.encode(text or "", add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_equals_the_tokenizer(make):
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()[:120]
    rows = [(i, t) for i, t in enumerate(ODD + texts + ODD[:3])] + [(None, "a b"), (3, "again")]
    got = bpe.encode_documents(make(rows).withColumn("n_tokens", F.lit("x")), PATH)
    assert rows_of(got) == sorted(((i, *expected(t)) for i, t in rows), key=repr)


def test_ids_and_empty_table(make):
    assert bpe.encode_documents(make([(1, "x")]).limit(0), PATH, ids=True).collect() == []
    row = bpe.encode_documents(make([(1, "The cat, the Cat.")]), PATH, ids=True).first()
    t = Tokenizer.from_file(PATH)
    assert row.token_ids == t.encode("The cat, the Cat.", add_special_tokens=False).ids


@pytest.mark.parametrize("broken", range(1, 40, 7))
def test_bad_joins_are_repaired(broken):
    """Joins declared bad are encoded again from the text, with the same result."""
    encoder = bpe.Encoder(PATH)
    text = " ".join(f"word{i % 17} and{i}" for i in range(2000))
    whole = next(encoder.documents(pa.array([text])))[0].tolist()
    real = encoder.sound
    encoder.sound = lambda sides: [g and i % broken != 0 for i, g in enumerate(real(sides))]
    assert next(encoder.documents(pa.array([text])))[0].tolist() == whole
    assert len(whole) == expected(text)[0]


def test_learned_words_do_not_depend_on_company():
    one, two = bpe.Encoder(PATH), bpe.Encoder(PATH)
    words = [w.encode() for w in "das der über naïve lo.. x; 12 'tis !? ça".split()]
    one.numbers(words)

    def ids(encoder, word):
        n = encoder.numbers([word])[0]
        return encoder.ids[encoder.starts[n]:encoder.starts[n] + encoder.sizes[n]].tolist()

    assert all(ids(one, w) == ids(two, w) for w in words)


def test_small_tables_and_steps_change_nothing(make, monkeypatch):
    for name, size in (("KEPT_CHUNKS", 2), ("KEPT_WORDS", 9), ("KEPT_JOINS", 1), ("STEP", 50), ("TOKENS", 7), ("TOGETHER", 3)):
        monkeypatch.setattr(bpe, name, size)
    encoder = bpe.Encoder(PATH)
    texts = [t or "" for t in ODD] + ["x " * 40 + "<|endoftext|> y, z.", "Ab ab. " * 30]
    rows = [r for some in encoder.documents(pa.array(texts)) for r in some]
    digits, names = list(encoder.digits.digests(rows)), list(encoder.decoded(rows))
    assert [(len(r), d, n) for r, d, n in zip(rows, digits, names)] == [expected(t) for t in texts]


def test_byte_level_tokenizers_keep_white_space():
    """Chunks are then encoded as they are, and joins repaired."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, t = bpe.Encoder(path), Tokenizer.from_file(path)
    texts = [" ".join(f"word{i % 17}  and{i}" for i in range(400)), "a b"]
    rows = [r.tolist() for some in encoder.documents(pa.array(texts)) for r in some]
    assert not encoder.by_words and rows == [t.encode(x, add_special_tokens=False).ids for x in texts]
