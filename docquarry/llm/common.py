"""Helpers of the operators: stored intermediate tables and array code for text batches.

The array code runs inside Arrow tasks.  It works on bounded pieces of a batch: the
texts of a few rows, end to end, as one byte array.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.session import shared_folder

#: A word: a run of bytes other than space and the five ASCII control spaces.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that one step of array code takes (one longer text is a step of its own).
PIECE = 2 << 20
#: Stands for a missing id: no document is smaller than itself, and it is above all ids.
NO_ID = (1 << 63) - 1

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def stored(df: DataFrame, name: str) -> DataFrame:
    """Rows written once to the shared folder and read back: lineage ends here, and a
    lost executor loses nothing."""
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session: the number that is set in step with the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def homes(count: int) -> list[int]:
    """For each of ``count`` shuffle partitions an int that Spark's hash (Murmur3) deals to it."""
    found = {}
    for first in range(0, 1 << 31, 1 << 16):
        numbers = np.arange(first, first + (1 << 16))
        x = (numbers * 0xCC9E2D51 & 0xFFFFFFFF).astype(np.uint64)
        x = ((x << np.uint64(15) | x >> np.uint64(17)) & np.uint64(0xFFFFFFFF)) * np.uint64(0x1B873593) & np.uint64(0xFFFFFFFF)
        x ^= np.uint64(42)
        x = ((x << np.uint64(13) | x >> np.uint64(19)) & np.uint64(0xFFFFFFFF)) * np.uint64(5) + np.uint64(0xE6546B64) & np.uint64(0xFFFFFFFF)
        x ^= np.uint64(4)
        for shift, times in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
            x = (x ^ x >> np.uint64(shift)) * np.uint64(times) & np.uint64(0xFFFFFFFF)
        for number, home in zip(numbers.tolist(), (x.astype(np.uint32).view(np.int32).astype(np.int64) % count).tolist()):
            found.setdefault(home, number)
        if len(found) == count:
            break
    return [found[i] for i in range(count)]


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``k`` (the id, NO_ID if null), ``th`` (hash of the text, tells apart rows that share
    an id), ``id`` and ``text`` of each row, whatever else the table holds."""
    frame = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return frame.select(F.coalesce("id", F.lit(NO_ID)).alias("k"),
                        F.xxhash64("text").alias("th"), "id", "text")


def word_count(text: str) -> Column:
    """Number of words of a text column (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_sql(value: str) -> str:
    """DuckDB SQL of the unsigned crc32 of a value's decimal digits."""
    bits = ("list_reduce(range(8), lambda s, i: CASE WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END, "
            "xor(a, b))")
    digits = f"list_transform(string_split(CAST({value} AS VARCHAR), ''), lambda z: CAST(ord(z) AS BIGINT))"
    return f"xor(list_reduce({digits}, lambda a, b: {bits}, CAST(4294967295 AS BIGINT)), 4294967295)"


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts end to end as bytes, and the offsets of the rows in them; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) else "")
    big = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    size = np.int64 if big else np.int32
    if offsets is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, size)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    bytes_ = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return bytes_[at[0]:at[-1]], at - at[0]


def pieces(texts: pa.Array, limit: int = PIECE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of rows of at most ``limit`` bytes, at least one row."""
    data, offsets = buffers(texts)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        at = offsets[row:end + 1]
        yield row, data[at[0]:at[-1]], at - at[0]
        row = end


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word, in order; words end with their row."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~_SPACE[data]
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, inside[:-1]
    heads = offsets[:-1]
    before[heads[heads < len(data)]] = False
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, inside[1:]
    tails = offsets[1:]
    after[tails[tails > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class Hasher:
    """Polynomial hashes modulo 2^64 over random byte values, one function per seed."""

    def __init__(self, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.table = rng.integers(0, 1 << 64, 256, np.uint64) | np.uint64(1)
        self.base = int(rng.integers(1 << 20, 1 << 62)) * 4 + 3
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) <= n:
            n = max(n, PIECE) + 1
            for name, base in (("up", self.base), ("down", pow(self.base, -1, 1 << 64))):
                out = np.full(n, base & ((1 << 64) - 1), np.uint64)
                out[0] = 1
                setattr(self, name, np.multiply.accumulate(out))

    def slices(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of data[start:end] for each pair."""
        self._powers(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.up[:len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.down[starts])

    def windows(self, values: np.ndarray, n: int) -> np.ndarray:
        """Hash of values[i:i+n] for each i that has n values; values are mixed hashes."""
        if len(values) < n:
            return np.zeros(0, np.uint64)
        base = self.base & ((1 << 64) - 1)
        total, power, done, size = None, values.astype(np.uint64), 0, 1
        while size <= n:  # runs of 1, 2, 4, ... values, and their sum for the bits of n
            if n & size:
                step = np.uint64(pow(base, size, 1 << 64))
                if total is None:
                    total = power
                else:
                    m = min(len(total), len(power) - done)
                    total = total[:m] * step + power[done:done + m]
                done += size
            size *= 2
            if size <= n:
                step, half = np.uint64(pow(base, size // 2, 1 << 64)), size // 2
                power = power[:len(power) - half] * step + power[half:]
        return mix(total[:len(values) - n + 1])


def planes(values: np.ndarray, kind: str = "<u4") -> bytes:
    """Byte planes of the values: the upper ones are nearly constant and compress to nothing."""
    x = np.ascontiguousarray(values.astype(kind))
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes()


def unplanes(raw: bytes, kind: str = "<u4") -> np.ndarray:
    width = np.dtype(kind).itemsize
    x = np.frombuffer(raw, np.uint8).reshape(width, -1)
    return np.ascontiguousarray(x.T).reshape(-1).view(kind)


def binaries(data: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Binary values that are consecutive runs of ``counts`` items of the array."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts * data.itemsize, out=offsets[1:])
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(counts),
        [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
