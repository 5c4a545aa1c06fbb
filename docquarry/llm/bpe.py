"""BPE encoding and decoding with reuse of content-defined chunks (7)."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docquarry.llm.common import Hasher, pieces, words_of
from docquarry.llm.tokencounts import spaces_drop, units

#: Words that a rolling hash looks at, and the mean number of words between boundaries.
ROLL, MEAN = 4, 48
#: Entries that a task keeps of chunks, words and joins, about 100 MB in all; a full table is
#: emptied.
KEPT_CHUNKS, KEPT_WORDS, KEPT_JOINS = 16_000, 400_000, 60_000
#: Bytes of text, and tokens, that one step of array code takes.
STEP, TOKENS = 1 << 20, 1 << 17
#: Words that are encoded as one text.
TOGETHER = 500

FIELDS = "n_tokens long, ids_sha256 string, decoded_sha256 string"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of each run, end to end."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


class Spelling:
    """A text for each token id, to write out many ids at once, with a space after each."""

    def __init__(self, texts: list[bytes]) -> None:
        self.sizes = np.array([len(t) + 1 for t in texts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join([t + b" " for t in texts]), np.uint8)

    def of(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The texts of the ids, and where each ends."""
        sizes = self.sizes[ids]
        return self.data[spread(self.starts[ids], sizes)].tobytes(), np.cumsum(sizes)

    def digests(self, rows: list[np.ndarray]) -> Iterator[str]:
        """SHA-256 of the texts of each row's ids, joined by one space."""
        at = 0
        while at < len(rows):
            end, tokens = at + 1, len(rows[at])
            while end < len(rows) and tokens + len(rows[end]) <= TOKENS:
                tokens += len(rows[end])
                end += 1
            if tokens > TOKENS:  # one long row, piece by piece
                state = hashlib.sha256()
                for first in range(0, tokens, TOKENS):
                    state.update(b" " * (first > 0) + self.of(rows[at][first:first + TOKENS])[0][:-1])
                yield state.hexdigest()
            else:
                text, ends = self.of(np.concatenate(rows[at:end]))
                view, stop = memoryview(text), np.cumsum([len(r) for r in rows[at:end]])
                cut = np.concatenate([[0], ends])[np.concatenate([[0], stop])].tolist()
                for a, b in zip(cut, cut[1:]):
                    yield hashlib.sha256(view[a:max(a, b - 1)]).hexdigest()
            at = end


class Encoder:
    """Encodes texts chunk by chunk, each distinct chunk once.

    A rolling hash over the last ROLL words puts a boundary before a word, so equal
    passages are cut alike wherever they stand.  A chunk that is already known brings
    its ids along.  A new one is put together from its words and punctuation, each encoded
    once by the tokenizer and then gathered by number.  Then the joins: the words on both
    sides of each boundary are encoded as one text; where that differs from both
    by themselves, the text around is encoded again, twice as wide each time, until both
    ends agree.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_words = spaces_drop(self.tokenizer)
        self.hasher = Hasher(7)
        self.chunks: dict[bytes, np.ndarray] = {}
        self.joins: dict[tuple[bytes, bytes], bool] = {}
        self.no_words()
        size = self.tokenizer.get_vocab_size()
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.digits = Spelling([str(i).encode() for i in range(size)])
        # Without a decoder component, decoding joins the tokens by spaces.
        self.names = Spelling([t.encode() for t in tokens]) if self.tokenizer.decoder is None else None
        self.last = np.array([t.endswith("</w>") for t in tokens])

    def no_words(self) -> None:
        self.words: dict[bytes, int] = {}
        self.ids, self.used = np.zeros(1 << 16, np.int32), 0
        self.starts = np.zeros(KEPT_WORDS, np.int64)
        self.sizes = np.zeros(KEPT_WORDS, np.int64)

    def forget(self) -> None:
        self.chunks.clear()
        self.joins.clear()
        self.no_words()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte positions where chunks begin, row starts included, and their rows."""
        starts, ends, rows = words_of(data, offsets)
        hashes = self.hasher.slices(data, starts, ends)
        rolled = self.hasher.windows(hashes, ROLL)
        word = np.arange(len(rolled)) + ROLL - 1
        word = word[(rolled >> np.uint64(20)) % np.uint64(MEAN) == 0]
        word = word[rows[word] == rows[word - ROLL + 1]]
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        at = np.unique(np.concatenate([starts[word], heads]))
        return at, np.searchsorted(offsets, at, "right") - 1

    def plain(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of words of ASCII letters, many in one text: each ends with a token that is
        marked as a word's last.  If the marks don't come out even, one by one."""
        out: list[np.ndarray] = []
        for at in range(0, len(words), TOGETHER):
            part = words[at:at + TOGETHER]
            ids = self.encode([b" ".join(part).decode()])[0]
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(part) and ends[-1] == len(ids):
                out += np.split(ids, ends[:-1])
            else:
                out += self.encode([w.decode() for w in part])
        return out

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Numbers of distinct words in the table, which learns those it doesn't hold."""
        if len(self.words) + len(words) > KEPT_WORDS:
            self.no_words()
            if len(words) > KEPT_WORDS:
                self.starts, self.sizes = np.zeros((2, len(words)), np.int64)
        new = [w for w in words if w not in self.words]
        letters, other = [w for w in new if w.isalpha()], [w for w in new if not w.isalpha()]
        found = self.plain(letters) + self.encode([w.decode() for w in other])
        if found:
            first, sizes = len(self.words), np.array([len(ids) for ids in found], np.int64)
            need = self.used + int(sizes.sum())
            if need > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(need, np.int32)])
            self.ids[self.used:need] = np.concatenate(found)
            self.starts[first:first + len(found)] = self.used + np.cumsum(sizes) - sizes
            self.sizes[first:first + len(found)] = sizes
            self.used = need
            self.words.update(zip(letters + other, range(first, first + len(found))))
        return np.array([self.words[w] for w in words], np.int64)

    def learn(self, new: list[bytes]) -> None:
        """Ids of chunks that are new, from the ids of their words; a chunk that may hold a
        special token, which is found before letters are lowered, is encoded as it is."""
        odd = [c for c in new if not self.by_words or b"<|" in c]
        self.chunks.update(zip(odd, self.encode([c.decode() for c in odd])))
        new = [c for c in new if c not in self.chunks]
        self.chunks.update(zip(new, self.assembled(new)))

    def assembled(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of texts, each put together from those of its words and punctuation."""
        if not texts:
            return []
        data = _LOWER[np.frombuffer(b"".join(texts), np.uint8)]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        starts, ends, rows = units(data, offsets, True)
        _, first, which = np.unique(self.hasher.slices(data, starts, ends), return_index=True, return_inverse=True)
        raw = data.tobytes()
        words = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        number = self.numbers(words)[which]
        sizes = self.sizes[number]
        ids = self.ids[spread(self.starts[number], sizes)]
        bounds = np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(rows, np.arange(len(texts) + 1))].tolist()
        return [ids[a:b].copy() for a, b in zip(bounds, bounds[1:])]

    def sound(self, sides: list[tuple[bytes, bytes]]) -> list[bool]:
        """Whether the ids of two neighbouring words also come from encoding both as one."""
        if len(self.joins) > KEPT_JOINS:
            self.joins.clear()
        new = [side for side in dict.fromkeys(sides) if side not in self.joins]
        apart = [word for side in new for word in side]
        parts = self.assembled(apart) if self.by_words else self.encode([w.decode() for w in apart])
        whole = self.encode([(a + b" " + b).decode() for a, b in new])
        for i, side in enumerate(new):
            self.joins[side] = np.array_equal(np.concatenate(parts[2 * i:2 * i + 2]), whole[i])
        return [self.joins[side] for side in sides]

    def repaired(self, chunks: list[bytes], join: int) -> tuple[int, int, np.ndarray]:
        """First and last chunk around a bad join, and the ids of the text in between."""
        width = 1
        while True:
            first, last = max(0, join - width), min(len(chunks), join + width)
            ids = self.encode([b"".join(chunks[first:last]).decode()])[0]
            head, tail = self.chunks[chunks[first]], self.chunks[chunks[last - 1]]
            if ((first == 0 or np.array_equal(ids[:len(head)], head))
                    and (last == len(chunks) or np.array_equal(ids[len(ids) - len(tail):], tail))):
                return first, last, ids
            width *= 2

    def row(self, own: list[bytes], bad: list[int]) -> np.ndarray:
        """Ids of one text, cut into chunks, of whose joins some need repair."""
        known, parts, done = self.chunks, [np.zeros(0, np.int32)], 0
        for join in bad:
            if join < done:
                continue
            first, last, fixed = self.repaired(own, join)
            if first < done:  # reaches into what is already repaired: all of it again
                parts = [self.encode([b"".join(own[:last]).decode()])[0]]
            else:
                parts += [known[c] for c in own[done:first]] + [fixed]
            done = last
        return np.concatenate(parts + [known[c] for c in own[done:]])

    def documents(self, texts: pa.Array) -> Iterator[list[np.ndarray]]:
        """Token ids of each text, in order, for some rows at a time."""
        for _, data, offsets in pieces(texts, STEP):
            at, rows = self.cuts(data, offsets)
            raw, edges = data.tobytes(), [*at.tolist(), len(data)]
            chunks = [raw[a:b] for a, b in zip(edges, edges[1:])]
            if len(self.chunks) > KEPT_CHUNKS:
                self.chunks.clear()
            self.learn([c for c in dict.fromkeys(chunks) if c not in self.chunks])
            inner = (np.flatnonzero(rows[1:] == rows[:-1]) + 1).tolist()
            sides = [((chunks[i - 1].lower().rsplit(None, 1) or [b""])[-1],
                      (chunks[i].lower().split(None, 1) or [b""])[0]) for i in inner]
            bad = [i for i, good in zip(inner, self.sound(sides)) if not good]
            bounds = np.searchsorted(rows, np.arange(len(offsets))).tolist()
            yield [self.row(chunks[a:b], [i - a for i in bad if a < i < b] if bad else [])
                   for a, b in zip(bounds, bounds[1:])]

    def decoded(self, rows: list[np.ndarray]) -> Iterator[str]:
        """SHA-256 of each row's decoded text."""
        if self.names is not None:
            return self.names.digests(rows)
        texts = self.tokenizer.decode_batch([r.tolist() for r in rows], skip_special_tokens=False)
        return (hashlib.sha256(t.encode()).hexdigest() for t in texts)


@lru_cache(1)
def encoder_of(path: str) -> Encoder:
    """The tokenizer is read once for a Python worker, which runs many tasks."""
    return Encoder(path)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                     ids: bool = False) -> DataFrame:
    """Encodes every whole text and decodes it again; one row out for each row in.

    Returns ``id_col``, ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by one
    space) and ``decoded_sha256``; with ``ids`` also ``token_ids``.  A null text counts as
    empty: no tokens, hashes of the empty string.  Repeated rows and ids, null ids and
    clashing extra columns make no difference: rows are never joined or grouped.  There
    is no shuffle; a task keeps tables of bounded size, and a chunk shared by documents of
    several tasks is encoded once in each.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        try:
            yield from encoded(encoder, batches)
        finally:  # the worker lives on, and other tasks need its memory
            encoder.forget()

    def encoded(encoder: Encoder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digits, names, found = [], [], [], []
            for rows in encoder.documents(batch.column(1)):
                sizes += [len(r) for r in rows]
                digits += encoder.digits.digests(rows)
                names += encoder.decoded(rows)
                found += rows if ids else []
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digits, pa.string()),
                       pa.array(names, pa.string())]
            labels = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                columns.append(pa.array(found, pa.list_(pa.int32())))
                labels.append("token_ids")
            yield pa.RecordBatch.from_arrays(columns, labels)

    frame = docs.select(id_col, text_col)
    kind = frame.schema[0].dataType.simpleString()
    schema = f"`{id_col}` {kind}, {FIELDS}" + (", token_ids array<int>" if ids else "")
    return frame.mapInArrow(run, schema)
