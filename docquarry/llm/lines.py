"""Removal of repeated content-defined chunks of lines (5)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.llm.common import Hasher, keyed, pieces, stored

#: Lines that a rolling hash looks at, and its modulus: about one line in MEAN ends a chunk.
ROLL, MEAN = 2, 3


def _lines(data: np.ndarray, offsets: np.ndarray):
    """Bytes with a line end after each row; start, end and row of each line; words before each byte."""
    data = np.insert(data, offsets[1:], 10)
    ends = np.flatnonzero(data == 10)
    starts = np.r_[0, ends[:-1] + 1][:len(ends)]
    rows = np.searchsorted(offsets[1:] + np.arange(1, len(offsets)), ends, "right")
    word = np.r_[0, np.cumsum((data > 32) | ((data < 9) | (data > 13)) & (data != 32))]
    return data, starts, ends, rows, word


def _cuts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, word: np.ndarray,
          hasher: Hasher, trim: bool) -> tuple[np.ndarray, np.ndarray]:
    """First line of each chunk of two lines and more that holds a word, and the line after its
    last; with ``trim`` without white space beyond the line next to a word."""
    hashes = hasher.slices(data, starts, ends)
    cut = np.zeros(len(ends) + 1, bool)
    rolled = hasher.windows(hashes, ROLL)
    cut[ROLL:ROLL + len(rolled)] = ((rolled >> np.uint64(16)) % np.uint64(MEAN) == 0) & (
        rows[:len(rolled)] == rows[ROLL - 1:][:len(rolled)])
    cut[1:] &= ~cut[:-1]
    head = np.r_[True, rows[1:] != rows[:-1]] if len(rows) else np.zeros(0, bool)
    first = np.flatnonzero(head | cut[:len(rows)])
    last = np.r_[first[1:], len(rows)][:len(first)]
    keep = (last - first > 1) & (word[ends[last - 1]] > word[starts[first]])
    first, last = first[keep], last[keep]
    if trim and len(first):
        full = np.flatnonzero(word[ends] > word[starts])
        first = np.maximum(first, full[np.searchsorted(full, first)] - 1)
        last = np.minimum(last, full[np.searchsorted(full, last) - 1] + 2)
    return first, last


def chunks_of(data: np.ndarray, offsets: np.ndarray, hasher: Hasher, trim: bool = False):
    """(bytes with a line end after each row, row, first line, lines, from, to, hash) of the
    chunks of two lines and more that hold a word.

    A line whose hash, rolled with that of the line before, is divisible by MEAN ends a
    chunk, unless the line before does.  So boundaries depend on three lines around, and a
    passage is cut alike wherever it stands, but for its edges.  With ``trim``, white space
    beyond the line next to a word is left out at both ends.
    """
    data, starts, ends, rows, word = _lines(data, offsets)
    first, last = _cuts(data, starts, ends, rows, word, hasher, trim)
    begin, end = starts[first], ends[last - 1]
    top = np.searchsorted(rows, rows[first])
    return data, rows[first], first - top, last - first, begin, end, hasher.slices(data, begin, end)


def pairs_of(data: np.ndarray, offsets: np.ndarray, hasher: Hasher):
    """As ``chunks_of``, of every two neighbouring lines that hold a word, and of every two
    lines that hold a word with more than two of white space between them; and the first line
    of the trimmed chunk that the pair lies in, -1 if it reaches beyond one.

    Every run of lines that begins and ends within a line of a word is a chain of these, so
    chains of repeated ones are the repeated runs, grown as far as they go.
    """
    data, starts, ends, rows, word = _lines(data, offsets)
    head, tail = _cuts(data, starts, ends, rows, word, hasher, True)
    worded = word[ends] > word[starts]
    first, full = np.flatnonzero(worded[:-1] | worded[1:]), np.flatnonzero(worded)
    wide = np.flatnonzero(np.diff(full) > 3)
    first, last = np.r_[first, full[wide]], np.r_[first + 1, full[wide + 1] if len(wide) else wide]
    same = rows[first] == rows[last]
    first, last = first[same], last[same]
    begin, end = starts[first], ends[last]
    top = np.searchsorted(rows, rows[first])
    inside = np.full(len(first), -1)
    if len(head):
        at = np.searchsorted(head, first, "right") - 1
        inside = np.where((at >= 0) & (last < tail[at]), head[at] - top, -1)
    return data, rows[first], first - top, last + 1 - first, begin, end, hasher.slices(data, begin, end), inside


def _units(kind: str, text: bool):
    """Rows of the chunks, the trimmed chunks or the pairs of texts: all, or with ``text`` those
    that begin in a wanted line, with their bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(51)
        for batch in batches:
            k, th = (np.asarray(batch.column(c)) for c in ("k", "th"))
            wanted = batch.column("wanted") if text else None
            for at, data, offsets in pieces(batch.column("text")):
                if kind == "pairs":
                    data, row, first, lines, begin, end, hashed, inside = pairs_of(data, offsets, hasher)
                else:
                    data, row, first, lines, begin, end, hashed = chunks_of(data, offsets, hasher, kind == "trimmed")
                    inside = np.full(len(row), -1)
                if text:
                    asked = [set(w.as_py()) for w in wanted.slice(at, len(offsets) - 1)]
                    keep = [i for i, (r, f) in enumerate(zip(row.tolist(), first.tolist())) if f in asked[r]]
                    row, first, lines, begin, end, hashed, inside = (
                        x[keep] for x in (row, first, lines, begin, end, hashed, inside))
                columns = [pa.array(hashed.view(np.int64)), pa.array(k[at + row]), pa.array(th[at + row]),
                           *(pa.array(x.astype(np.int32)) for x in (first, lines, inside))]
                names = ["h", "k", "th", "first", "lines", "inside"]
                if text:
                    raw = data.tobytes()
                    columns.append(pa.array([raw[a:b] for a, b in zip(begin, end)], pa.binary()))
                    names.append("chunk")
                yield pa.RecordBatch.from_arrays(columns, names)
    return run


def _rebuilt(id_col: str, text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], [], [], []]
            for value, gone in zip(batch.column("text"), batch.column("gone")):
                value, gone = value.as_py() or "", gone.as_py()
                lines = value.split("\n") if value else []
                kept = value
                if gone:
                    away = {i for g in gone for i in range(g["first"], g["first"] + g["lines"])}
                    kept = "\n".join([x for i, x in enumerate(lines) if i not in away])
                out[0].append(len(lines))
                out[1].append(len(away) if gone else 0)
                out[2].append(hashlib.sha256(kept.encode()).hexdigest())
                out[3].append(kept)
            columns = [batch.column("k"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                       pa.array(out[2], pa.string())] + [pa.array(out[3], pa.string())] * text
            yield pa.RecordBatch.from_arrays(
                columns, [id_col, "n_lines", "n_removed", "kept_sha256"] + ["kept_text"] * text)
    return run


UNIT = "h long, k long, th long, first int, lines int, inside int"


def _repeated(units: DataFrame) -> DataFrame:
    """Units whose hash comes more than once."""
    return units.join(units.groupBy("h").count().where("count > 1").select("h"), "h", "left_semi")


def _later(frame: DataFrame, repeated: DataFrame, kind: str) -> DataFrame:
    """``k``, ``th``, ``first`` and ``lines`` of the units that stand before, byte for byte."""
    wanted = repeated.groupBy("k", "th").agg(F.collect_set("first").alias("wanted"))
    places = stored(frame.select("k", "th", "text").join(wanted, ["k", "th"]).select("k", "th", "text", "wanted")
                    .mapInArrow(_units(kind, True), UNIT + ", chunk binary"), kind)
    # Equal hash and equal bytes: the first place keeps the chunk.
    kept = places.groupBy("h", "chunk").agg(F.min(F.struct("k", "th", "first")).alias("keeper"))
    later = F.struct("k", "th", "first") != F.col("keeper")
    if kind == "pairs":  # a place that overlaps the first one isn't a repeat of it
        later = ((F.col("k") != F.col("keeper.k")) | (F.col("th") != F.col("keeper.th"))
                 | (F.col("first") >= F.col("keeper.first") + F.col("lines")))
    return places.join(kept, ["h", "chunk"]).where(later).select("k", "th", "first", "lines")


def removals(frame: DataFrame, whole: bool = False) -> DataFrame:
    """``k``, ``th`` and ``gone`` (first line and number of lines of each chunk to remove, and with
    ``whole`` of each pair of lines beyond them that is to go).

    With ``whole``, the chunks that stand before go first.  They are then grown, and runs that hold
    no whole chunk found, by the pairs of lines that don't lie in one of these: the first place of
    a pair never does, so every pair is still held against its first place.
    """
    rows = frame.select("k", "th", "text")
    kind = "trimmed" if whole else "chunks"
    gone = _later(rows, _repeated(rows.mapInArrow(_units(kind, False), UNIT)), kind)
    if whole:
        gone = stored(gone, "gone")
        inner = gone.select("k", "th", F.col("first").alias("inside")).distinct()
        pairs = rows.mapInArrow(_units("pairs", False), UNIT).join(inner, ["k", "th", "inside"], "left_anti")
        gone = gone.unionByName(_later(rows, _repeated(pairs), "pairs"))
    return gone.groupBy("k", "th").agg(F.collect_set(F.struct("first", "lines")).alias("gone"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   text: bool = False, whole: bool = False) -> DataFrame:
    """Removes chunks of two lines and more that stand in the corpus before, byte for byte.

    The first place of a chunk, by id, keeps it.  With ``whole``, not only whole chunks go
    but every run of lines, from two lines on, that stands before: repeated chunks are grown by
    pairs of neighbouring lines, so the shortest run that is always caught is of two lines with a
    word in one of them.  White space beyond the line next to a word is no part of a run.
    The first place of a line stays.  Returns, for each row, ``id_col``,
    ``n_lines``, ``n_removed`` (lines), ``kept_sha256`` (of the lines left, joined by line
    ends) and, with ``text``, ``kept_text``.

    Null and empty texts have no lines.  A null id is above all others.  Single lines,
    and chunks of white space, stay.  Repeated rows are one document and come out alike;
    rows that share an id with different texts come in order of a hash of the text.  A
    text of repeated chunks only comes out empty.  Other columns play no part.
    """
    frame = keyed(docs, id_col, text_col).select("k", "th", "text", F.col("id").isNull().alias("none"))
    out = frame.select("k", "th", "text").join(removals(frame, whole), ["k", "th"], "left").select(
        "k", "text", "gone").mapInArrow(
        _rebuilt(id_col, text), f"`{id_col}` long, n_lines long, n_removed long, kept_sha256 string"
        + ", kept_text string" * text)
    return out.withColumn(id_col, F.when(F.col(id_col) < (1 << 63) - 1, F.col(id_col)))


def shortened(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> DataFrame:
    """All columns of the rows, the text without repeated chunks, and ``lines_removed``.

    As ``remove_repeats``; a text that loses nothing stays what it is, null included.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("k"),
                       F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).alias("text"))
    joined = rows.join(removals(rows, whole), ["k", "th"], "left").select("row", "gone")
    parts = F.split(F.col(f"row.{text_col}"), "\n", -1)
    gone = F.array_distinct(F.flatten(F.transform(
        "gone", lambda g: F.sequence(g["first"], g["first"] + g["lines"] - 1))))
    kept = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains(gone, i)), "\n")
    return joined.select(
        *[(F.when(F.col("gone").isNotNull(), kept).otherwise(F.col(f"row.`{text_col}`")) if c == text_col
           else F.col(f"row.`{c}`")).alias(c) for c in docs.columns],
        F.coalesce(F.size(gone), F.lit(0)).alias("lines_removed"))
