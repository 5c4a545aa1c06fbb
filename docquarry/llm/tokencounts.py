"""Token counts by a map-side lookup in two tiers (12)."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.llm.common import mix, pieces

#: Entries of the broadcast table: 18 bytes each, 2.4 MB.
ENTRIES = 1 << 17
#: Pre-tokens of a part of the text that a summary keeps between merges.
SUMMARY = 1 << 17
#: Summaries that one task merges.
FAN = 32
#: Bytes of a pre-token that fit the table's key, whose last byte is the length.
SHORT = 15
#: Entries of a worker's cache, and the longest pre-token it holds.
CACHED, CACHED_BYTES = 250_000, 256
#: Documents above so many tokens are over the limit.
LIMIT = 2048

_SPACE, _LETTER, _CLOSING = 1, 2, 3
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = _SPACE
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_KIND[np.frombuffer(b",.!?;:", np.uint8)] = _CLOSING


def units(data: np.ndarray, offsets: np.ndarray, fine: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every pre-token: a run without white space; ``fine`` cuts it
    where ASCII letters and closing punctuation meet.

    Both are places where a tokenizer of words and punctuation cuts as well, whatever stands
    around them: letters end a match of punctuation and the other way round, and neither
    white space nor this punctuation takes part in contractions, special tokens or
    compositions of characters.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    kind = _KIND[data]
    change = np.ones(len(data) + 1, bool)
    one, two = kind[:-1], kind[1:]
    if fine:
        change[1:-1] = (((one == _SPACE) | (two == _SPACE)) & (one != two)
                        | (one == _LETTER) & (two == _CLOSING) | (one == _CLOSING) & (two == _LETTER))
    else:
        change[1:-1] = (one == _SPACE) != (two == _SPACE)
    change[offsets] = True
    at = np.flatnonzero(change)
    starts, ends = at[:-1], at[1:]
    keep = kind[starts] != _SPACE
    starts, ends = starts[keep], ends[keep]
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two words for each pre-token of at most SHORT bytes: its bytes and its length."""
    length = ends - starts
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    cells = np.lib.stride_tricks.sliding_window_view(padded, 16)[starts]
    cells = np.where(np.arange(16) < length[:, None], cells, np.uint8(0))
    cells[:, 15] = length
    both = np.ascontiguousarray(cells).view("<u8")
    return both[:, 0], both[:, 1]


def spelled(low: int, high: int) -> bytes:
    raw = int(low).to_bytes(8, "little") + int(high).to_bytes(8, "little")
    return raw[:raw[15]]


class Table:
    """Numbers by key: open addressing in arrays, looked up for many keys at once."""

    def __init__(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> None:
        bits = max(4, int(2 * len(low)).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.low, self.high = np.zeros((2, 1 << bits), np.uint64)
        self.value = np.zeros(1 << bits, np.uint16)
        slot, todo = self.slots(low, high), np.arange(len(low))
        while len(todo):
            at = slot[todo].astype(np.int64)
            free = np.flatnonzero(self.high[at] == 0)  # a length is never 0
            _, first = np.unique(at[free], return_index=True)
            new = free[first]
            self.low[at[new]], self.high[at[new]] = low[todo[new]], high[todo[new]]
            self.value[at[new]] = value[todo[new]]
            todo = np.delete(todo, new)
            slot[todo] = (slot[todo] + np.uint64(1)) & self.mask

    def slots(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return mix(low ^ mix(high)) & self.mask

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The value of each key, -1 if there is none."""
        out = np.full(len(low), -1, np.int64)
        slot, todo = self.slots(low, high), np.arange(len(low))
        while len(todo):
            at = slot[todo].astype(np.int64)
            held = self.high[at]
            hit = (held == high[todo]) & (self.low[at] == low[todo])
            out[todo[hit]] = self.value[at[hit]]
            todo = todo[~hit & (held != 0)]
            slot[todo] = (slot[todo] + np.uint64(1)) & self.mask
        return out


class Lengths:
    """Number of tokens of a pre-token, with a bounded cache."""

    def __init__(self, path: str) -> None:
        self.cache: dict[bytes, int] = {}
        if path.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.fine, self.whole = False, True
            self.count = lambda texts: [len(i) for i in model.encode(texts, num_threads=1)]
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.count = lambda texts: [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        self.fine, self.whole = True, not spaces_drop(tokenizer)

    def of(self, words: list[bytes]) -> list[int]:
        new = [w for w in dict.fromkeys(words) if w not in self.cache]
        found = dict(zip(new, self.count([w.decode() for w in new]))) if new else {}
        out = [found[w] if w in found else self.cache[w] for w in words]
        if len(self.cache) + len(found) > CACHED:
            self.cache.clear()
        self.cache.update((w, n) for w, n in found.items() if len(w) <= CACHED_BYTES)
        return out


def spaces_drop(tokenizer) -> bool:
    """Whether white space only separates, and what it separates is encoded by itself."""
    probes = ["a b", "A\t\nb.", "x,y z", "it's 'tis a.b ?!", "un deux  trois"]
    texts = [p for probe in probes for p in (probe, *probe.split())]
    ids = iter([e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)])
    return all(next(ids) == [i for _ in probe.split() for i in next(ids)] for probe in probes)


@lru_cache(1)
def lengths_of(path: str) -> Lengths:
    """Read once for a Python worker, which keeps its cache from task to task."""
    return Lengths(path)


def kept(low: np.ndarray, high: np.ndarray, count: np.ndarray, most: int):
    """Counts summed by key; of more than ``most`` the highest, less the highest that goes,
    so a key's count is too low by that at most."""
    order = np.lexsort((low, high))
    low, high, count = low[order], high[order], count[order]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    at = np.flatnonzero(new)
    low, high = low[at], high[at]
    count = np.add.reduceat(count, at) if len(at) else count
    if len(count) > most:
        cut = np.partition(count, len(count) - most - 1)[len(count) - most - 1]
        above = count > cut
        low, high, count = low[above], high[above], count[above] - cut
    return low, high, count


def _summary(low: np.ndarray, high: np.ndarray, count: np.ndarray) -> pa.Array:
    return pa.array([np.concatenate([low, high, count.astype("<u8")]).tobytes()], pa.binary())


def _unpacked(raw: bytes):
    low, high, count = np.frombuffer(raw, "<u8").reshape(3, -1)
    return low, high, count.astype(np.int64)


def frequent(docs: DataFrame, text_col: str, fine: bool, most: int = ENTRIES) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the most frequent short pre-tokens of all texts.

    Every task counts its own and keeps a summary of fixed size; summaries are merged FAN at
    a time, so neither pre-tokens nor their counts are ever shuffled as rows.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)]
        for batch in batches:
            for _, data, offsets in pieces(batch.column(0)):
                starts, ends, _ = units(data, offsets, fine)
                short = ends - starts <= SHORT
                low, high = keys(data, starts[short], ends[short])
                held = kept(*[np.concatenate(two) for two in zip(held, (low, high, np.ones(len(low), np.int64)))],
                            SUMMARY)
        part = pa.array([TaskContext.get().partitionId()], pa.int64())
        yield pa.RecordBatch.from_arrays([part, _summary(*held)], ["part", "summary"])

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        held = None
        for raw in table["summary"]:
            one = _unpacked(raw.as_buffer())
            held = one if held is None else kept(*[np.concatenate(two) for two in zip(held, one)], SUMMARY)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "summary": _summary(*held)})

    texts = docs.select(text_col)
    left = texts.rdd.getNumPartitions()
    parts = texts.mapInArrow(count, "part long, summary binary")
    while left > 1:
        parts = parts.groupBy(F.floor(F.col("part") / FAN).alias("to")).applyInArrow(
            merge, "part long, summary binary")
        left = -(-left // FAN)
    low, high, times = np.zeros((3, 0), np.uint64)
    for row in parts.collect():  # one row of fixed size
        low, high, times = _unpacked(row["summary"])
    best = np.lexsort((low, high, -times.astype(np.int64)))[:most]
    return low[best], high[best]


def lookup(lengths: Lengths, table: Table | None, texts: pa.Array) -> np.ndarray:
    """Number of tokens of each text: the table first, then the cache, then the tokenizer."""
    total = np.zeros(len(texts), np.int64)
    for first, data, offsets in pieces(texts):
        rows_here = len(offsets) - 1
        if lengths.whole:
            raw, at = data.tobytes(), offsets.tolist()
            total[first:first + rows_here] = lengths.count([raw[a:b].decode() for a, b in zip(at, at[1:])])
            continue
        starts, ends, rows = units(data, offsets, lengths.fine)
        found = np.full(len(starts), -1, np.int64)
        short = np.flatnonzero(ends - starts <= SHORT)
        low, high = keys(data, starts[short], ends[short])
        found[short] = table.find(low, high)
        missed = found[short] < 0
        order = np.lexsort((low[missed], high[missed]))
        low, high, short = low[missed][order], high[missed][order], short[missed][order]
        new = np.ones(len(low), bool)
        new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        words = [spelled(a, b) for a, b in zip(low[new].tolist(), high[new].tolist())]
        found[short] = np.asarray(lengths.of(words), np.int64)[np.cumsum(new) - 1] if words else 0
        long = np.flatnonzero(ends - starts > SHORT)
        found[long] = lengths.of([data[a:b].tobytes() for a, b in zip(starts[long].tolist(), ends[long].tolist())])
        total[first:first + rows_here] = np.bincount(rows, found, rows_here).astype(np.int64)
    return total


#: The table of the last query that a worker served.
_served: dict[str, Table] = {}


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of every whole text.

    The ENTRIES most frequent short pre-tokens of all texts are encoded once, and a table of
    their lengths, of fixed size, is broadcast; keys are the bytes themselves, so a hit is
    exact.  What misses goes to the worker's bounded cache, and what that misses to the
    tokenizer, each distinct pre-token of a piece of text once.  Pre-tokens are
    never shuffled, and no row leaves its task.

    One row out for each row in.  A null text counts as empty: no bytes, no tokens.  Null and
    repeated ids, repeated rows and other columns make no difference.  Tokenizers
    for which white space is part of tokens (SentencePiece, byte-level ones) have no pre-tokens
    of this kind: their texts are encoded whole.
    """
    spark = docs.sparkSession
    lengths = lengths_of(path)
    if lengths.whole:
        shared, name = None, ""
    else:
        low, high = frequent(docs, text_col, lengths.fine)
        value = lengths.count([spelled(a, b).decode() for a, b in zip(low.tolist(), high.tolist())]) if len(low) else []
        shared, name = spark.sparkContext.broadcast((low, high, np.asarray(value, np.uint16))), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lengths_of(path)
        if shared is not None and name not in _served:
            _served.clear()
            _served[name] = Table(*shared.value)
        for batch in batches:
            texts = batch.column(1)
            tokens = lookup(own, _served.get(name), texts)
            size = pc.coalesce(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), size, pa.array(tokens, pa.int64()), pa.array(tokens > limit)],
                [id_col, "n_bytes", "n_tokens", "over_limit"])

    frame = docs.select(id_col, text_col)
    kind = frame.schema[0].dataType.simpleString()
    return frame.mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
