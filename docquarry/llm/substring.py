"""Repeated word windows, found behind a count-min prefilter (3)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.llm.common import (Hasher, keyed, mix, partitions, pieces, planes, unplanes,
                                  words_of)
from docquarry.llm.prefilter import WIDTH_BITS, by_document, repeated, sketch

#: Candidate windows a task holds before it sends them on.
HELD = 3_000_000

_LONG = "k long, th long, runs binary"


class Windows:
    """Hashes of every window of n consecutive words of a row.

    The anchor of a window is the smallest hash of the runs of about n/2 words inside.  It
    depends on the window's words alone, so a window's anchor is found wherever the window
    is, and neighbouring windows mostly have the same one.
    """

    def __init__(self, n: int) -> None:
        self.n, self.run, self.one, self.two = n, (n + 1) // 2, Hasher(31), Hasher(32)

    def anchors(self, data: np.ndarray, offsets: np.ndarray):
        """(anchor, row) of each window."""
        return self.of(data, offsets)[2:4]

    def of(self, data: np.ndarray, offsets: np.ndarray):
        """(hash, second hash, anchor, row, number of the first word in its row)."""
        starts, ends, rows = words_of(data, offsets)
        hashes = self.one.slices(data, starts, ends)
        a = self.one.windows(hashes, self.n)
        b = self.two.windows(self.two.slices(data, starts, ends), self.n)
        anchor, size = self.one.windows(hashes, self.run), 1
        width = self.n - self.run + 1
        while size < width:  # the smallest of 2, 4, ... and in the end width neighbours
            step = min(size, width - size)
            anchor = np.minimum(anchor[:max(0, len(anchor) - step)], anchor[step:])
            size += step
        first = np.searchsorted(rows, np.arange(len(offsets) - 1))
        row = rows[:len(a)]
        whole = np.flatnonzero(row == rows[self.n - 1:][:len(a)])
        row = row[whole]
        return a[whole], b[whole], anchor[whole], row, whole - first[row]


def _covered(a, b, owner, start, names, texts) -> tuple[np.ndarray, np.ndarray]:
    """For windows with equal hashes: order, and whether a smaller document has it too."""
    order = np.lexsort((start, names[owner], b, a))
    a, b, name = a[order], b[order], names[owner[order]]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    least = name[np.flatnonzero(new)][np.cumsum(new) - 1]
    return order, name > least


def _candidates(heavy: Broadcast, n: int, bits: int, buckets: int):
    """Windows that the sketch holds for repeated, by bucket of their anchor.

    Documents of one task settle what they can among themselves: of equal windows only
    those of the smallest document go on, so a window of any number of documents is sent
    once a task at most.
    """
    def send(a, b, anchor, owner, start, names, texts):
        order, covered = _covered(a, b, owner, start, names, texts)
        gone = order[covered]
        if len(gone):
            found = by_document(owner[gone], start[gone], names, texts)
            where = pa.array(-1 - (np.asarray(found.column("k")) % buckets).astype(np.int32))
            yield pa.RecordBatch.from_arrays([where, *found.columns], ["bucket", "k", "th", "runs"])
        left = order[~covered]
        bucket = (mix(anchor[left]) % np.uint64(buckets)).astype(np.int64)
        left = left[np.lexsort((start[left], owner[left], bucket))]
        bucket = (mix(anchor[left]) % np.uint64(buckets)).astype(np.int64)
        edges = np.searchsorted(bucket, np.arange(buckets + 1))
        for i in np.flatnonzero(np.diff(edges)):
            part = left[edges[i]:edges[i + 1]]
            docs, own = np.unique(owner[part], return_inverse=True)
            blob = b"".join([
                np.array([len(part), len(docs)], "<i8").tobytes(), a[part].astype("<u8").tobytes(),
                b[part].astype("<u4").tobytes(), planes(np.diff(own, prepend=0)),
                planes(start[part]), names[docs].astype("<i8").tobytes(),
                texts[docs].astype("<i8").tobytes()])
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([0], pa.int64()), pa.array([0], pa.int64()),
                 pa.array([blob], pa.binary())], ["bucket", "k", "th", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(n)
        held, names, texts, count, docs = [], [], [], 0, 0

        def flush():
            yield from send(*(np.concatenate(x) for x in zip(*held)), np.concatenate(names),
                            np.concatenate(texts))

        for batch in batches:
            k, th = (np.asarray(batch.column(c)) for c in ("k", "th"))
            for first, data, offsets in pieces(batch.column("text")):
                a, b, anchor, row, start = windows.of(data, offsets)
                some = repeated(anchor, heavy.value, bits)
                m = len(offsets) - 1
                if some.any():
                    held.append((a[some], b[some] & np.uint64(0xFFFFFFFF), anchor[some],
                                 row[some] + docs, start[some]))
                    count += len(held[-1][0])
                names.append(k[first:first + m])
                texts.append(th[first:first + m])
                docs += m
                if count > HELD:
                    yield from flush()
                    held, names, texts, count, docs = [], [], [], 0, 0
        if held:
            yield from flush()
    return run


def _resolve(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups the windows of a bucket exactly, by 96 bits of hash."""
    parts = []
    for batch in batches:
        if key[0].as_py() < 0:  # settled where they were found
            yield batch.select(["k", "th", "runs"])
            continue
        for blob in batch.column("runs"):
            raw = blob.as_py()
            n, m = np.frombuffer(raw, "<i8", 2)
            at = 16

            def take(count, kind):
                nonlocal at
                at += (size := int(count) * np.dtype(kind).itemsize)
                return raw[at - size:at]
            a = np.frombuffer(take(n, "<u8"), "<u8")
            b = np.frombuffer(take(n, "<u4"), "<u4")
            own = np.cumsum(unplanes(take(n, "<u4")).astype(np.int64))
            start = unplanes(take(n, "<u4")).astype(np.int64)
            k, th = (np.frombuffer(take(m, "<i8"), "<i8") for _ in range(2))
            parts.append((a, b, own, start, k, th))
    if parts:
        shift = np.cumsum([0] + [len(p[4]) for p in parts])
        a, b, start, names, texts = (np.concatenate([p[i] for p in parts]) for i in (0, 1, 3, 4, 5))
        owner = np.concatenate([p[2] + s for p, s in zip(parts, shift)])
        order, covered = _covered(a, b, owner, start, names, texts)
        gone = order[covered]
        if len(gone):
            yield by_document(owner[gone], start[gone], names, texts)


def repeated_windows(docs: DataFrame, n: int, bits: int = WIDTH_BITS) -> DataFrame:
    """``k``, ``th`` and ``runs`` (binary lists of 32-bit first windows and lengths): windows of each
    document that also start in a document with a smaller id."""
    keys = docs.select("k", "th", "text")
    heavy = sketch(keys, partial(Windows, n), bits)
    buckets = 4 * partitions(docs.sparkSession)
    sent = keys.mapInArrow(_candidates(heavy, n, bits, buckets),
                           f"bucket int, {_LONG}")
    found = sent.groupBy("bucket").applyInArrow(_resolve, _LONG)
    return found.groupBy("k", "th").agg(F.collect_list("runs").alias("runs"))


def remove_repeats(docs: DataFrame, n: int = 13, id_col: str = "doc_id", text_col: str = "text",
                   bits: int = WIDTH_BITS, text: bool = False) -> DataFrame:
    """Removes words that stand in a window of n words which a smaller document has too.

    A first pass counts all windows in merged count-min sketches, which never estimate too
    low; a second groups only those windows that are estimated repeated, exactly.  Windows
    are judged on the input.  Returns, for each row, ``id_col``, ``n_words``, ``n_removed``,
    ``kept_sha256`` (kept words joined by a space) and, with ``text``, ``kept_text``.

    Null text: no words.  A null id is above all others.  Rows that share an id don't
    remove from each other; repeated rows are returned as often as they come.  Texts are
    read whole, with fewer than n words nothing is removed.  Other columns play no part.
    """
    frame = keyed(docs, id_col, text_col)
    hits = repeated_windows(frame, n, bits)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], [], [], []]
            for value, runs in zip(batch.column("text"), batch.column("runs")):
                words = (value.as_py() or "").encode().split()
                total, blobs = len(words), runs.as_py()
                if blobs:
                    gone = np.zeros(total + 1, np.int32)
                    runs = np.unique(np.frombuffer(b"".join(blobs), "<i4").reshape(-1, 2), axis=0)
                    np.add.at(gone, runs[:, 0], 1)
                    np.subtract.at(gone, runs.sum(axis=1) + n - 1, 1)
                    keep = np.cumsum(gone[:total]) == 0
                    words = [w for w, k in zip(words, keep.tolist()) if k]
                kept = b" ".join(words)
                out[0].append(total)
                out[1].append(total - len(words))
                out[2].append(hashlib.sha256(kept).hexdigest())
                if text:
                    out[3].append(kept.decode())
            columns = [batch.column("id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                       pa.array(out[2], pa.string())] + [pa.array(out[3], pa.string())] * text
            yield pa.RecordBatch.from_arrays(
                columns, [id_col, "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * text)

    schema = (f"`{id_col}` long, n_words long, n_removed long, kept_sha256 string"
              + ", kept_text string" * text)
    return frame.join(hits, ["k", "th"], "left").select("id", "text", "runs").mapInArrow(finish, schema)


#: The same rows in DuckDB, for windows of 13 words.
WINDOW_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
k AS (SELECT doc_id, i, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i
    ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS win,
  count(*) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS n FROM p),
f AS (SELECT win, min(doc_id) AS first FROM k WHERE n = 13 GROUP BY win),
c AS (SELECT DISTINCT doc_id, i + j AS i FROM k JOIN f USING (win), range(13) AS t(j)
  WHERE n = 13 AND first < doc_id),
s AS (SELECT p.doc_id, count(*) AS n_words, count(c.i) AS n_removed,
    coalesce(string_agg(word, ' ' ORDER BY p.i) FILTER (WHERE c.i IS NULL), '') AS kept
  FROM p LEFT JOIN c ON p.doc_id = c.doc_id AND p.i = c.i GROUP BY p.doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN s USING (doc_id)
"""
