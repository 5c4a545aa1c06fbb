"""Repeated byte strings by difference-cover suffix sorting (2)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.llm.common import Hasher, homes, keyed, mix, partitions, pieces, planes, unplanes
from docquarry.llm.prefilter import HASHED, KEY_BITS, among, cells, shared_counters, unpacked

#: Bytes of candidate text a task holds before it sends them on.
HELD = 48 << 20
#: Parts of a bucket whose suffixes are sorted one after the other.
PARTS = 64
#: Bytes of segments in one batch of rows.
BATCH = 8 << 20


# Difference cover modulo 3: for any two places some shift below 3 leads both to places
# that are 1 or 2 modulo 3.
_SHIFT = np.array([[1, 1, 2], [1, 0, 0], [2, 0, 0]])


def _named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names 1, 2, ... in order of the keys, and that order."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), np.int64)
    new[1:] = ordered[1:] != ordered[:-1]
    names = np.empty(len(keys), np.int64)
    names[order] = np.cumsum(new)
    return names, order


def suffix_order(s: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, ranks) of the suffixes of ``s`` by their first ``depth`` items at least.

    Suffixes at places 1 and 2 modulo 3 are the sample.  Their triples are sorted and
    named; while names don't settle ``depth`` items, the string of names is sorted the
    same way.  The other suffixes are sorted by one item and the rank of the sampled
    suffix behind it, and merged in by comparing from the shift that leads both sides to
    the sample.  Suffixes that agree as far as was looked have equal ranks.
    """
    n = len(s)
    if depth <= 1 or not n:
        return _named(s)[::-1]
    s = np.r_[s.astype(np.int64) + 1, np.zeros(3, np.int64)]
    one, two = np.arange(1, n, 3), np.arange(2, n, 3)
    sample, base = np.concatenate([one, two]), int(s.max()) + 1
    if base < 1 << 20:
        key = lambda i: (s[i] * base + s[i + 1]) * base + s[i + 2]
        names, order = _named(key(sample))
    else:
        key = lambda i: s[i] * base + s[i + 1]
        names, order = _named(_named(key(sample))[0] * base + s[sample + 2])
    if depth > 3:
        order, deep = suffix_order(np.r_[names[:len(one)], 0, names[len(one):]], -(-depth // 3) + 1)
        names = np.r_[deep[:len(one)], deep[len(one) + 1:]]
        order = order[order != len(one)]
        order = order - (order > len(one))
    rank = np.zeros(n + 3, np.int64)
    rank[sample] = names
    sample = sample[order]
    rest = np.arange(0, n, 3)
    rest = rest[np.argsort(s[rest] * (n + 2) + rank[rest + 1])]
    # Where each of the rest goes among the sample: among those with the same first items,
    # by binary search for all at once.
    low, high = (np.searchsorted(key(sample), key(rest), side) for side in ("left", "right"))
    while (active := np.flatnonzero(low < high)).size:
        middle = (low[active] + high[active]) // 2
        i, j = rest[active], sample[middle]
        shift = np.where(j % 3 == 1, 1, 2)
        less = rank[j + shift] < rank[i + shift]
        low[active] = np.where(less, middle + 1, low[active])
        high[active] = np.where(less, high[active], middle)
    # Among suffixes that agree in ``depth`` items the comparisons may contradict each other.
    low = np.maximum.accumulate(low)
    order = np.full(n, -1)
    order[low + np.arange(len(rest))] = rest
    order[order < 0] = sample
    i, j = order[:-1], order[1:]
    shift = _SHIFT[i % 3, j % 3]
    same = ((rank[i + shift] == rank[j + shift]) & ((shift < 1) | (s[i] == s[j]))
            & ((shift < 2) | (s[i + 1] == s[j + 1])))
    ranks = np.empty(n, np.int64)
    ranks[order] = np.cumsum(np.r_[1, ~same])
    return order, ranks


def repeats_at(data: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Number of the class of each start, by the n bytes from there: suffixes are sorted, and
    neighbours that agree in n bytes are in one class."""
    order, _ = suffix_order(data, n)
    wanted = np.full(len(data), -1, np.int64)
    wanted[starts] = np.arange(len(starts))
    order = order[wanted[order] >= 0]
    raw = np.r_[data, np.zeros(8, np.uint8)].tobytes()
    word = np.ndarray((len(data) + 1,), "<u8", raw, strides=(1,))
    same = np.ones(max(0, len(order) - 1), bool)
    for at in [*range(0, n - 7, 8), *([n - 8] if n % 8 and n > 8 else [])] if n >= 8 else []:
        same &= word[order[:-1] + at] == word[order[1:] + at]
    for at in range(n if n < 8 else 0):
        same &= data[order[:-1] + at] == data[order[1:] + at]
    out = np.empty(len(starts), np.int64)
    out[wanted[order]] = np.cumsum(np.r_[0, ~same])[:len(order)]
    return out


class Segments:
    """Runs of places in a row whose n bytes have the same anchor.

    The anchor of n bytes is the smallest hash of the strings of about n/2 bytes inside; so
    equal strings have equal anchors, and neighbouring places mostly share one.
    """

    def __init__(self, n: int) -> None:
        self.n, self.run, self.hasher = n, (n + 1) // 2, Hasher(21)

    def of(self, data: np.ndarray, offsets: np.ndarray):
        """(anchor, row, first place in the bytes, places) of each segment."""
        anchor, size = self.hasher.windows(self.hasher.table[data], self.run), 1
        width = self.n - self.run + 1
        while size < width:
            step = min(size, width - size)
            anchor = np.minimum(anchor[:max(0, len(anchor) - step)], anchor[step:])
            size += step
        last = np.maximum(offsets[1:] - self.n + 1, offsets[:-1])  # places end before
        first, last = offsets[:-1][last > offsets[:-1]], last[last > offsets[:-1]]
        new = np.zeros(len(anchor) + 1, bool)
        new[1:-1] = anchor[1:] != anchor[:-1]
        new[first] = new[last] = True
        edges = np.flatnonzero(new)
        inside = np.searchsorted(first, edges, "right") > np.searchsorted(last, edges, "right")
        starts = edges[inside]
        ends = edges[np.flatnonzero(inside) + 1] if len(starts) else starts
        return anchor[starts], np.searchsorted(offsets, starts, "right") - 1, starts, ends - starts

    def anchors(self, data: np.ndarray, offsets: np.ndarray):
        return self.of(data, offsets)[:2]


class Content:
    """128 bits of hash of strings that lie end to end."""

    def __init__(self) -> None:
        self.one, self.two = Hasher(22), Hasher(23)

    def classes(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the class of equal strings, first string of each class)."""
        a, b = np.zeros((2, len(sizes)), np.uint64)
        ends = np.cumsum(sizes)
        row = 0
        while row < len(sizes):  # bounded pieces: powers are kept up to the longest one
            stop = max(row + 1, int(np.searchsorted(ends, (ends[row - 1] if row else 0) + HASHED, "right")))
            base = ends[row - 1] if row else 0
            part = data[base:ends[stop - 1]]
            begin, end = ends[row:stop] - sizes[row:stop] - base, ends[row:stop] - base
            a[row:stop], b[row:stop] = self.one.slices(part, begin, end), self.two.slices(part, begin, end)
            row = stop
        order = np.lexsort((b, a))
        new = np.ones(len(order), bool)
        new[1:] = (a[order[1:]] != a[order[:-1]]) | (b[order[1:]] != b[order[:-1]])
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        return number, order[new]


def _gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The strings data[start:start+size], end to end."""
    raw = memoryview(np.ascontiguousarray(data))
    return np.frombuffer(b"".join([raw[i:j] for i, j in zip(starts.tolist(), (starts + sizes).tolist())]), data.dtype)


def _least(number: np.ndarray, count: int, names: np.ndarray) -> np.ndarray:
    out = np.full(count, np.iinfo(np.int64).max)
    np.minimum.at(out, number, names)
    return out


def _notes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, pa.RecordBatch]]:
    """(notes, documents) of each batch of a group; all notes come before the first document."""
    begun = False
    for batch in batches:
        kinds = np.asarray(batch.column("kind"))
        if (np.diff(kinds) < 0).any() or begun and len(kinds) and not kinds[0]:
            raise RuntimeError("notes of a group came after its documents")
        first = int(np.searchsorted(kinds, 1))
        begun |= first < len(kinds)
        yield batch.slice(0, first), batch.slice(first)


class Numbers:
    """Numbers 0, 1, ... of a group's documents, which come in order of k and th; rows that share both
    have one number."""

    def __init__(self) -> None:
        self.last, self.count = None, -1

    def of(self, batch: pa.RecordBatch) -> np.ndarray:
        k, th = (np.asarray(batch.column(c)) for c in ("k", "th"))
        new = np.ones(len(k), np.int64)
        new[1:] = (k[1:] != k[:-1]) | (th[1:] != th[:-1])
        new[:1] = (k[0], th[0]) != self.last
        numbers = self.count + np.cumsum(new)
        self.last, self.count = (k[-1], th[-1]), int(numbers[-1])
        return numbers


def _joined(owner: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner and first place in one number, length) of each run of places, in order."""
    key = owner << 32 | start
    key.sort()
    first = np.flatnonzero(np.diff(key, prepend=-2) > 1)
    last = np.r_[first[1:], len(key)][:len(first)] - 1
    return key[first], key[last] - key[first] + 1


def _written(number: np.ndarray, start: np.ndarray, places: np.ndarray) -> bytes:
    """Runs of places, in order of the documents' numbers."""
    return planes(np.diff(number, prepend=0)) + planes(start) + planes(places)


def _runs(notes: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All that was ``_written``, in order of the documents' numbers."""
    parts = [[unplanes(raw[i:i + len(raw) // 3]).astype(np.int64) for i in range(0, len(raw), len(raw) // 3)] for raw in notes]
    number = np.concatenate([np.cumsum(x[0]) for x in parts])
    order = np.argsort(number)
    return number[order], *(np.concatenate([x[i] for x in parts])[order] for i in (1, 2))


def _candidates(n: int, bits: int, where: list[int]):
    """Segments whose anchor is shared with another document, by bucket of the anchor.

    Of segments with equal text only those of a group's smallest document go on; places in
    its other documents are covered already.
    """
    def rows(*columns):
        return pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(columns, (pa.int32(), pa.int32(), pa.binary()))], ["bucket", "g", "note"])

    def send(group, content, texts, anchor, owner, start, places, names, numbers):
        data, sizes = np.concatenate(texts), places + n - 1
        number, first = content.classes(data, sizes)
        covered = names[owner] > _least(number, len(first), names[owner])[number]
        if covered.any():
            first, count = _joined(*_places(numbers[owner[covered]], start[covered], places[covered]))
            yield rows([-1 - group], [group], [_written(first >> 32, first & 0xFFFFFFFF, count)])
        begin = np.cumsum(sizes) - sizes
        bucket = (mix(anchor) % np.uint64(len(where))).astype(np.int64)
        left = np.flatnonzero(~covered)
        left = left[np.lexsort((start[left], owner[left], bucket[left]))]
        edges = np.searchsorted(bucket[left], np.arange(len(where) + 1))
        used, blobs, size = [], [], 0
        for i in np.flatnonzero(np.diff(edges)):
            part = left[edges[i]:edges[i + 1]]
            docs, own = np.unique(owner[part], return_inverse=True)
            used.append(where[i])
            blobs.append(b"".join([
                np.array([len(part), len(docs)], "<i8").tobytes(), (anchor[part] >> np.uint64(32)).astype("<u4").tobytes(),
                planes(places[part]), planes(np.diff(own, prepend=0)), planes(start[part]),
                planes(np.diff(names[docs], prepend=0), "<u8"), planes(np.diff(numbers[docs], prepend=0)),
                _gather(data, begin[part], sizes[part]).tobytes()]))
            size += len(blobs[-1])
            if size > BATCH:
                yield rows(used, [group] * len(used), blobs)
                used, blobs, size = [], [], 0
        if blobs:
            yield rows(used, [group] * len(used), blobs)

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments, content = Segments(n), Content()
        shared, told = np.zeros(0, np.int64), []
        texts, held, names, numbers, size, docs, numbered = [], [], [], [], 0, 0, Numbers()
        for notes, batch in _notes(batches):
            told += [unpacked(raw) for raw in notes.column("note").to_pylist()]
            if not batch.num_rows:
                continue
            if told:
                shared, told = np.sort(np.concatenate([shared, *told])), []
            k, number = np.asarray(batch.column("k")), numbered.of(batch)
            for at, data, offsets in pieces(batch.column("bytes"), HASHED):
                anchor, row, start, places = segments.of(data, offsets)
                some = among(cells(anchor, 0, bits), shared)
                m = len(offsets) - 1
                names.append(k[at:at + m])
                numbers.append(number[at:at + m])
                if some.any():
                    texts.append(_gather(data, start[some], places[some] + n - 1))
                    held.append((anchor[some], row[some] + docs, start[some] - offsets[row[some]], places[some]))
                    size += len(texts[-1])
                docs += m
                if size > HELD:
                    yield from send(key[0].as_py(), content, texts, *(np.concatenate(x) for x in zip(*held)),
                                    np.concatenate(names), np.concatenate(numbers))
                    texts, held, names, numbers, size, docs = [], [], [], [], 0, 0
        if held:
            yield from send(key[0].as_py(), content, texts, *(np.concatenate(x) for x in zip(*held)),
                            np.concatenate(names), np.concatenate(numbers))
    return run


def _places(owner: np.ndarray, start: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and start of every place of the segments."""
    first = np.cumsum(places) - places
    return np.repeat(owner, places), np.arange(places.sum()) + np.repeat(start - first, places)


def _settle(n: int, content: Content, anchor, places, owner, start, least_of, data):
    """(owner, first place) of the covered places of segments: whole ones by equal text, then, for
    anchors with several texts, place by place in the sorted suffixes of the distinct texts."""
    sizes = places + n - 1
    number, first = content.classes(data, sizes)
    least = _least(number, len(first), least_of)
    whole = least_of > least[number]
    found = [_places(owner[whole], start[whole], places[whole])]
    # Distinct texts of anchors that have several of them.
    _, at, several = np.unique(anchor[first], return_inverse=True, return_counts=True)
    some = np.flatnonzero(several[at] > 1)
    if len(some):
        begin = (np.cumsum(sizes) - sizes)[first[some]]
        text = _gather(data, begin, sizes[first[some]])
        ends = np.cumsum(sizes[first[some]])
        owner_, start_ = _places(np.arange(len(some)), ends - sizes[first[some]], places[first[some]])
        group = repeats_at(text, start_, n)
        lowest = _least(group, group.max() + 1, least[some[owner_]])[group]
        hit = np.flatnonzero(lowest < least[some[owner_]])
        # Each such place in every segment of that text whose document is the smallest.
        segment = some[owner_[hit]]
        offset = start_[hit] - (ends - sizes[first[some]])[owner_[hit]]
        rest = np.flatnonzero(~whole)
        rest = rest[np.argsort(number[rest], kind="stable")]
        low, high = np.searchsorted(number[rest], segment), np.searchsorted(number[rest], segment, "right")
        turn, place = _places(np.arange(len(segment)), low, high - low)
        found.append((owner[rest[place]], start[rest[place]] + offset[turn]))
    return (np.concatenate(x) for x in zip(*found))


def _resolve(n: int):
    """Settles the segments of a bucket, a part of its anchors at a time."""
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, group = [], []
        for batch in batches:
            if key[0].as_py() < 0:  # settled where they were found
                yield batch.select(["g", "note"])
                continue
            for g, blob in zip(batch.column("g").to_pylist(), batch.column("note")):
                raw = blob.as_py()
                count, m = np.frombuffer(raw, "<i8", 2)
                at = 16

                def take(items, kind):
                    nonlocal at
                    at += (size := int(items) * np.dtype(kind).itemsize)
                    return raw[at - size:at]
                anchor = np.frombuffer(take(count, "<u4"), "<u4")
                places, own, start = (unplanes(take(count, "<u4")).astype(np.int64) for _ in range(3))
                names = np.cumsum(unplanes(take(m, "<u8"), "<u8").view(np.int64))
                numbers = np.cumsum(unplanes(take(m, "<u4")).astype(np.int64))
                parts.append((anchor, places, np.cumsum(own), start, names, numbers, np.frombuffer(raw, np.uint8)[at:]))
                group.append(g)
        if not parts:
            return
        shift = np.cumsum([0] + [len(p[4]) for p in parts])
        anchor, places, start, names, numbers, data = (np.concatenate([p[i] for p in parts]) for i in (0, 1, 3, 4, 5, 6))
        owner = np.concatenate([p[2] + s for p, s in zip(parts, shift)])
        parts.clear()
        begin = np.cumsum(places + n - 1) - (places + n - 1)
        share, content, found = mix(anchor.astype(np.uint64)) % np.uint64(PARTS), Content(), []
        for i in range(PARTS):
            if len(own := np.flatnonzero(share == i)):
                found.append(_joined(*_settle(n, content, anchor[own], places[own], owner[own], start[own], names[owner[own]],
                                              _gather(data, begin[own], places[own] + n - 1))))
        first, count = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(first)
        first, count = first[order], count[order]
        edges = np.searchsorted(first, shift << 32)
        used = np.flatnonzero(np.diff(edges))
        notes = [_written(numbers[first[x] >> 32], first[x] & 0xFFFFFFFF, count[x])
                 for x in (slice(edges[i], edges[i + 1]) for i in used)]
        yield pa.RecordBatch.from_arrays([pa.array([group[i] for i in used], pa.int32()), pa.array(notes, pa.binary())],
                                         ["g", "note"])
    return run


def _dealt(docs: DataFrame, where: list[int]) -> DataFrame:
    """Documents with the group ``g`` that ``k`` and ``th`` deal them to, one group a partition.

    They are read three times in one plan.  Each reads all columns, and all columns are expressions:
    so the three are equal to Spark and it shuffles the documents once.
    """
    every = F.split(F.lit(",".join(map(str, where))), ",")
    group = every[F.pmod(F.xxhash64("k", "th"), F.lit(len(where))).cast("int")].cast("int")
    return docs.select("k", "th", F.col("id").alias("number"), F.col("text").cast("binary").alias("bytes"),
                       group.alias("g")).repartition(len(where), "g")


def _beside(dealt: DataFrame, notes: DataFrame):
    """Documents by group in order of k and th, behind the notes (``g``, ``note``) on the group.  Only
    notes are shuffled."""
    of = dealt.select("g", F.lit(1).alias("kind"), "k", "th", "number", "bytes", F.lit(None).cast("binary").alias("note"))
    none = [F.lit(None).cast(t) for t in ("long", "long", "long", "binary")]
    on = notes.repartition(partitions(dealt.sparkSession), "g").select("g", F.lit(0), *none, "note")
    return of.union(on).sortWithinPartitions("g", "kind", "k", "th").groupBy("g")


def repeated_strings(dealt: DataFrame, where: list[int], n: int, bits: int = KEY_BITS) -> DataFrame:
    """``g`` and ``note`` (read by ``_runs``): places of each document whose n bytes also start in a
    document with a smaller id."""
    shared = shared_counters(dealt, partial(Segments, n), bits).withColumnRenamed("keys", "note")
    sent = _beside(dealt, shared).applyInArrow(_candidates(n, bits, where), "bucket int, g int, note binary")
    return sent.groupBy("bucket").applyInArrow(_resolve(n), "g int, note binary")


def remove_repeats(docs: DataFrame, n: int = 50, id_col: str = "doc_id", text_col: str = "text",
                   bits: int = KEY_BITS, kept: bool = False) -> DataFrame:
    """Removes bytes covered by a string of n bytes that also starts in a smaller document.

    Strings that can't repeat are left out first: those whose anchor a count-min sketch
    estimates in one document.  The others are dealt out by anchor, so that equal strings meet,
    and as segments of neighbouring places, so that no text travels n times.  Inside each part
    the suffixes of the distinct segments are sorted by the difference-cover method, and
    neighbours are compared in n bytes.  Strings are judged on the input; texts are UTF-8.
    Documents are shuffled once, into groups; what is found out about a group comes to it.

    Returns, for each row, ``id_col``, ``n_bytes``, ``n_removed``, ``n_spans`` (runs of removed
    bytes), ``kept_sha256`` and, with ``kept``, ``kept_bytes``.

    Null text is empty.  A null id is above all others.  Rows that share an id don't remove
    from each other; repeated rows are returned as often as they come.  Texts are read
    whole and matches end with them.  Other columns play no part.
    """
    where = homes(partitions(docs.sparkSession))
    dealt = _dealt(keyed(docs, id_col, text_col), where)
    hits = repeated_strings(dealt, where, n, bits)

    def finish(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told, (number, start, places), numbered = [], np.zeros((3, 0), np.int64), Numbers()
        for notes, batch in _notes(batches):
            told += notes.column("note").to_pylist()
            if not batch.num_rows:
                continue
            if told:
                (number, start, places), told = _runs(told), []
            own = numbered.of(batch)
            low, high = (np.searchsorted(number, own, side).tolist() for side in ("left", "right"))
            out = [[], [], [], [], []]
            for value, i, j in zip(batch.column("bytes"), low, high):
                raw = value.as_py() or b""
                left, removed, spans = raw, 0, 0
                if i < j:
                    change = np.zeros(len(raw) + 2, np.int32)
                    np.add.at(change, start[i:j] + 1, 1)
                    np.subtract.at(change, start[i:j] + places[i:j] + n, 1)
                    gone = np.cumsum(change) > 0
                    spans = int((gone[1:] & ~gone[:-1]).sum())
                    gone = gone[1:-1]
                    left = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                    removed = len(raw) - len(left)
                for column, x in zip(out, (len(raw), removed, spans, hashlib.sha256(left).hexdigest(), left)):
                    column.append(x)
            columns = [batch.column("number"), *(pa.array(c, pa.int64()) for c in out[:3]),
                       pa.array(out[3], pa.string())] + [pa.array(out[4], pa.binary())] * kept
            yield pa.RecordBatch.from_arrays(
                columns, [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept_bytes"] * kept)

    schema = (f"`{id_col}` long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
              + ", kept_bytes binary" * kept)
    return _beside(dealt, hits).applyInArrow(finish, schema)


#: The same rows in DuckDB, for strings of 50 bytes; a byte is two hexadecimal digits.
STRING_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS b FROM documents),
p AS (SELECT doc_id, unnest(b) AS byte, generate_subscripts(b, 1) AS i FROM d),
k AS (SELECT doc_id, i, byte, string_agg(byte, '') OVER (PARTITION BY doc_id ORDER BY i
  ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING) AS win FROM p),
f AS (SELECT win, min(doc_id) AS first FROM k WHERE len(win) = 100 GROUP BY win),
c AS (SELECT k.doc_id, i, byte, max(CASE WHEN first < k.doc_id THEN 1 ELSE 0 END) OVER (
  PARTITION BY k.doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM k LEFT JOIN f ON k.win = f.win AND len(k.win) = 100),
e AS (SELECT *, lag(gone, 1, 0) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM c),
s AS (SELECT doc_id, count(*) AS n_bytes, CAST(sum(gone) AS BIGINT) AS n_removed,
    count(*) FILTER (WHERE gone = 1 AND before = 0) AS n_spans,
    coalesce(string_agg(byte, '' ORDER BY i) FILTER (WHERE gone = 0), '') AS kept FROM e GROUP BY doc_id)
SELECT doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM documents LEFT JOIN s USING (doc_id)
"""
