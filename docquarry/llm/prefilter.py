"""Count-min prefilters for repeated windows, used by the substring operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from docquarry.llm.common import binaries, mix, partitions, pieces, planes, unplanes

#: Counters of a sketch row, as a power of two.  A row is broadcast as one bit a counter
#: ("two or more"): 32 MB each at 28, whatever the size of the input.
WIDTH_BITS = 28
#: Parts of a row that are merged by different tasks, as a power of two.
SHARD_BITS = 6
#: Anchors a task holds before it sends their counters.
HELD = 3_000_000
#: Bytes that are hashed at a time, so that the arrays stay in the processor's cache.
HASHED = 32 << 10
#: Counters of the sketch that is counted by groups of documents, as a power of two: 2^40 take
#: 4 G anchors with one in 250 wrongly held for shared.  40 at most (_packed).
KEY_BITS = 40


def cells(anchors: np.ndarray, row: int, bits: int) -> np.ndarray:
    """Counters of the anchors in a row of the sketch."""
    mixed = mix(anchors ^ np.uint64(0x5DEECE66D * (row + 1)))
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


def sketch(docs: DataFrame, make: Callable, bits: int = WIDTH_BITS) -> Broadcast:
    """Which counters of the corpus' count-min sketch stand at two or more.

    ``make`` gives what has ``anchors(data, offsets)``, the anchor and row of each window.
    What is counted is anchors, once for each run of windows that have one: a window's
    anchor is in every document that the window is in, so its count is never below the
    window's.  Each task counts in sketches of its own (two rows of 2^bits counters that
    stop at 2), and sends the counters in use.  The sketches are merged part by part, by
    adding up.  What comes back is one bit a counter, a fixed 2 * 2^bits / 8 bytes.
    """
    low = bits - SHARD_BITS
    size = 1 << low

    def send(row: int, found: np.ndarray) -> Iterator[pa.RecordBatch]:
        found.sort()
        new = np.flatnonzero(np.r_[True, found[1:] != found[:-1]])
        used, two = found[new], np.diff(np.r_[new, len(found)]) > 1
        edges = np.searchsorted(used, np.arange((1 << SHARD_BITS) + 1) * size)
        for shard in np.flatnonzero(np.diff(edges)):
            part = slice(edges[shard], edges[shard + 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array([row * (1 << SHARD_BITS) + shard], pa.int32()),
                 pa.array([planes(np.diff(used[part], prepend=shard * size))], pa.binary()),
                 pa.array([np.packbits(two[part]).tobytes()], pa.binary())],
                ["part", "used", "two"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = make()
        held, waiting = ([], []), 0
        for batch in batches:
            for _, data, offsets in pieces(batch.column(0)):
                anchor, owner = windows.anchors(data, offsets)
                new = np.ones(len(anchor), bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
                for row in range(2):
                    held[row].append(cells(anchor[new], row, bits))
                waiting += len(held[0][-1])
                if waiting > HELD:
                    for row in range(2):
                        yield from send(row, np.concatenate(held[row]))
                    held, waiting = ([], []), 0
        if waiting:
            for row in range(2):
                yield from send(row, np.concatenate(held[row]))

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.uint8)
        for batch in batches:
            for used, two in zip(batch.column("used"), batch.column("two")):
                at = np.cumsum(unplanes(used.as_py()).astype(np.int64))
                more = np.unpackbits(np.frombuffer(two.as_py(), np.uint8), count=len(at))
                total[at] = np.minimum(2, total[at] + 1 + more)
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()),
             pa.array([np.packbits(total == 2, bitorder="little").tobytes()], pa.binary())],
            ["part", "heavy"])

    merged = (docs.select("text").mapInArrow(count, "part int, used binary, two binary")
              .groupBy("part").applyInArrow(merge, "part int, heavy binary"))
    rows = np.zeros((2 << SHARD_BITS, size // 8), np.uint8)
    for part in merged.toLocalIterator():
        rows[part.part] = np.frombuffer(part.heavy, np.uint8)
    return docs.sparkSession.sparkContext.broadcast(rows.tobytes())


def repeated(anchors: np.ndarray, heavy: bytes, bits: int) -> np.ndarray:
    """Which anchors the sketch estimates at two or more."""
    rows, some = np.frombuffer(heavy, np.uint8).reshape(2, -1), np.ones(len(anchors), bool)
    for row in range(2):
        at = cells(anchors, row, bits)
        some &= (rows[row][at >> 3] >> (at & 7).astype(np.uint8)) & 1 != 0
    return some


def _packed(keys: np.ndarray) -> bytes:
    """Sorted keys below 2^40: byte planes of their differences."""
    return planes(np.diff(keys, prepend=0), "<u8")[:5 * len(keys)]


def unpacked(raw: bytes) -> np.ndarray:
    return np.cumsum(unplanes(raw + bytes(3 * (len(raw) // 5)), "<u8").astype(np.int64))


def among(keys: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Which keys are among the sorted ones."""
    if not len(some):
        return np.zeros(len(keys), bool)
    return some[np.minimum(np.searchsorted(some, keys), len(some) - 1)] == keys


def _by_key(keys: np.ndarray, names: np.ndarray, shared: np.ndarray):
    """Each key once, in order, with one of its names and whether it has several or is known to be shared."""
    order = np.argsort(keys)
    keys, names, shared = keys[order], names[order], shared[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    shared[1:] |= ~new[1:] & (names[1:] != names[:-1])
    heads = np.flatnonzero(new)
    return keys[heads], names[heads], np.logical_or.reduceat(shared, heads) if len(heads) else shared


def shared_counters(dealt: DataFrame, make: Callable, bits: int = KEY_BITS) -> DataFrame:
    """``g`` and ``keys`` (read by ``unpacked``): the counters of each group of documents that have
    two ids, or two groups, in the whole corpus.

    A count-min sketch of one row of 2^bits counters, of which only those in use are kept.
    ``dealt`` has the documents (``k``, ``bytes``) by group ``g``.  A group sends each of its
    counters once, to the task that has this part of the row; that task sends back to each group
    those that are shared.  So what a task holds doesn't grow with the corpus, as what is
    broadcast to all would.  A string's anchor is in every document that has the string, so no
    counter of a string that two ids have is left out.
    """
    parts = max(1, min(partitions(dealt.sparkSession) // 2, 1 << bits))

    def ask(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, held, waiting = make(), [], 0
        for batch in batches:
            names = np.asarray(batch.column("k"))
            for at, data, offsets in pieces(batch.column("bytes"), HASHED):
                anchor, row = windows.anchors(data, offsets)
                held.append((cells(anchor, 0, bits), names[at + row], np.zeros(len(anchor), bool)))
                waiting += len(anchor)
                if waiting > HELD:
                    held, waiting = [_by_key(*(np.concatenate(x) for x in zip(*held)))], 0
        if not held:
            return
        keys, _, shared = _by_key(*(np.concatenate(x) for x in zip(*held)))
        edges = np.searchsorted(keys * parts >> bits, np.arange(parts + 1))
        used = np.flatnonzero(np.diff(edges))
        runs = [slice(edges[i], edges[i + 1]) for i in used]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([key[0].as_py()] * len(used), pa.int32()),
             pa.array([_packed(keys[x]) for x in runs], pa.binary()),
             pa.array([np.packbits(shared[x]).tobytes() for x in runs], pa.binary())],
            ["part", "g", "keys", "shared"])

    def answer(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, asked, known = [], [], []
        for batch in batches:
            for g, raw, bit in zip(*(batch.column(c).to_pylist() for c in ("g", "keys", "shared"))):
                groups.append(g)
                asked.append(unpacked(raw))
                known.append(asked[-1][np.unpackbits(np.frombuffer(bit, np.uint8), count=len(asked[-1])) > 0])
        every = np.sort(np.concatenate(asked))
        shared = np.unique(np.concatenate([every[1:][every[1:] == every[:-1]], *known]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(groups, pa.int32()), pa.array([_packed(x[among(x, shared)]) for x in asked], pa.binary())],
            ["g", "keys"])

    return (dealt.groupBy("g").applyInArrow(ask, "part int, g int, keys binary, shared binary")
            .groupBy("part").applyInArrow(answer, "g int, keys binary"))


def by_document(owner, start, names, texts) -> pa.RecordBatch:
    """Covered windows, one row for each document: first window and length of each run."""
    order = np.lexsort((start, owner))
    owner, start = owner[order], start[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (start[1:] > start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(owner)][:len(first)] - 1
    runs = np.stack([start[first], start[last] - start[first] + 1], 1).astype("<i4")
    owner = owner[first]
    heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else owner
    counts = 2 * np.diff(np.r_[heads, len(owner)])
    return pa.RecordBatch.from_arrays(
        [pa.array(names[owner[heads]], pa.int64()), pa.array(texts[owner[heads]], pa.int64()),
         binaries(runs.reshape(-1), counts)], ["k", "th", "runs"])
