"""Toxicity by a subsequence string kernel, Nyström landmarks and a support vector machine (6)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.llm.common import Hasher, pieces, stored, words_of

#: Bounds of what the classifier is fitted on and made of: labelled rows, landmark words.
SAMPLE, LANDMARKS = 20_000, 160
#: Subsequences have three letters within SPAN; each letter skipped costs a factor DECAY.
SPAN, DECAY = 7, 0.6
#: Words count for a landmark by similarity to the power of SHARP, from LEAST on.
SHARP, LEAST = 4, 0.5
#: Score from which a text is called toxic.
THRESHOLD = 0.3

_CODES = 32 ** 3
_STEPS = [(a, b, DECAY ** (b - 2)) for b in range(2, SPAN) for a in range(1, b)]

# Letters a-z are symbols 1 to 26 in either case.  Letters of more than one byte are told
# apart by the last bits of their last byte.  Everything else is left out.
_SYMBOL = np.zeros(256, np.uint8)
_SYMBOL[97:123] = _SYMBOL[65:91] = np.arange(1, 27)
_SYMBOL[0x80:0xC0] = 27 + np.arange(64) % 5


def symbols(data: np.ndarray, offsets: np.ndarray):
    """(symbols, start, end, row) of the words of the texts.

    Digits and punctuation inside a word are passed over, and a run of words of one letter
    is one word, so "s t u p i d" and "st-up!id" read as the word they hide.
    """
    starts, ends, rows = words_of(data, offsets)
    at = np.flatnonzero(_SYMBOL[data])
    word = np.searchsorted(starts, at, "right") - 1
    single = np.bincount(word, minlength=len(starts)) == 1
    new = np.ones(len(starts), bool)
    new[1:] = ~(single[1:] & single[:-1] & (rows[1:] == rows[:-1]))
    group = (np.cumsum(new) - 1)[word]
    heads = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(at) else at
    return _SYMBOL[data[at]], heads, np.r_[heads[1:], len(at)] if len(at) else at, rows[word[heads]]


def _flat(symbol: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Symbols of the words end to end, letters left from each on, first position of each word."""
    size = end - start
    first = np.cumsum(size) - size
    at = np.arange(size.sum()) + np.repeat(start - first, size)
    left = np.repeat(first + size, size) - np.arange(len(at))
    return symbol[at].astype(np.int64), left, first


def _features(symbol: np.ndarray, start: np.ndarray, end: np.ndarray):
    """(word, subsequence, weight), each subsequence of a word once, with its total weight."""
    flat, left, first = _flat(symbol, start, end)
    owner = np.repeat(np.arange(len(start)), end - start)
    keys, weights = [np.zeros(0, np.int64)], [np.zeros(0)]
    for a, b, weight in _STEPS:
        at = np.flatnonzero(left > b)
        keys.append(owner[at] * _CODES + (flat[at] << 10 | flat[at + a] << 5 | flat[at + b]))
        weights.append(np.full(len(at), weight))
    keys, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return keys // _CODES, keys % _CODES, np.bincount(inverse, np.concatenate(weights), len(keys))


class Kernel:
    """Similarity of words to landmark words: the normalized gap-weighted subsequence kernel."""

    def __init__(self, landmarks: list[bytes]) -> None:
        data = np.frombuffer(b"".join(landmarks), np.uint8)
        end = np.cumsum([len(x) for x in landmarks])
        start = end - [len(x) for x in landmarks]
        word, code, weight = _features(data, start, end)
        norm = np.sqrt(np.bincount(word, weight ** 2, len(landmarks)))
        self.table = np.zeros((_CODES, len(landmarks)), np.float32)
        self.table[code, word] = weight / norm[word]
        self.most = self.table.max(axis=1)
        self.square = np.zeros((len(landmarks),) * 2)
        for i in range(len(landmarks)):
            self.square[i] = self.of(data, start[i:i + 1], end[i:i + 1])[1][0]
        self.hasher = Hasher(61)

    def near(self, symbol, start, end) -> np.ndarray:
        """Which words may reach LEAST: an upper bound of the kernel, by the largest weight
        that any landmark has, over a lower bound of the word's norm."""
        flat, left, first = _flat(symbol, start, end)
        total, norm = np.zeros(len(flat), np.float32), np.zeros(len(flat), np.float32)
        for a, b, weight in _STEPS:
            n = len(flat) - b
            if n <= 0:
                break
            value = self.most[flat[:n] << 10 | flat[a:a + n] << 5 | flat[b:]]
            fits = left[:n] > b
            total[:n] += np.where(fits, np.float32(weight) * value, 0)
            norm[:n] += np.where(fits, np.float32(weight * weight), 0)
        if not len(flat):
            return np.zeros(len(start), bool)
        total, norm = np.add.reduceat(total, first), np.add.reduceat(norm, first)
        return total * 1.001 >= LEAST * np.sqrt(norm)

    def of(self, symbol, start, end) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers, similarities to all landmarks) of the words that have subsequences."""
        word, code, weight = _features(symbol, start, end)
        if not len(word):
            return np.zeros(0, np.int64), np.zeros((0, self.table.shape[1]))
        heads = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        norm = np.sqrt(np.add.reduceat(weight ** 2, heads))
        sums = np.empty((len(heads), self.table.shape[1]))
        for i in range(0, len(heads), 2000):
            a = heads[i]
            b = heads[i + 2000] if i + 2000 < len(heads) else len(word)
            sums[i:i + 2000] = np.add.reduceat(
                self.table[code[a:b]] * weight[a:b, None], heads[i:i + 2000] - a)
        value = np.minimum(sums / norm[:, None], 1)
        return word[heads], np.where(value >= LEAST, value, 0) ** SHARP

    def documents(self, texts: pa.Array) -> np.ndarray:
        """Sum over the distinct words of each text, by landmark."""
        out = []
        for _, data, offsets in pieces(texts):
            symbol, start, end, row = symbols(data, offsets)
            long_ = end - start > 2
            start, end, row = start[long_], end[long_], row[long_]
            sums = np.zeros((len(offsets) - 1, self.table.shape[1]))
            out.append(sums)
            _, first, inverse = np.unique(self.hasher.slices(symbol, start, end),
                                          return_index=True, return_inverse=True)
            near = np.flatnonzero(self.near(symbol, start[first], end[first]))
            word, values = self.of(symbol, start[first[near]], end[first[near]])
            some = values.any(axis=1)
            place = np.full(len(first), -1)
            place[near[word[some]]] = np.flatnonzero(some)
            hit = place[inverse] >= 0
            pairs = np.unique(np.stack([row[hit], place[inverse[hit]]], 1), axis=0)
            np.add.at(sums, pairs[:, 0], values[pairs[:, 1]])
        return np.concatenate(out) if out else np.zeros((0, self.table.shape[1]))


@dataclass
class Model:
    """A fitted classifier: small, whatever it was fitted on."""

    landmarks: list[bytes]
    project: np.ndarray  # to Nyström features
    weights: np.ndarray  # the last is the bias
    slope: float
    shift: float

    def score(self, sums: np.ndarray) -> np.ndarray:
        if not self.landmarks:
            return np.full(len(sums), 1 / (1 + np.exp(-self.shift)))
        margin = np.log1p(sums) @ self.project @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -40, 40)))


def _svm(x: np.ndarray, y: np.ndarray, c: float = 1.0) -> np.ndarray:
    """Weights (bias last) of a linear machine with squared hinge loss, by Newton steps."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-6
    cost = lambda w: w @ ridge @ w / 2 + c * (np.maximum(0, 1 - y * (x @ w)) ** 2).sum()
    for _ in range(50):
        active = y * (x @ w) < 1
        a = x[active]
        step = np.linalg.solve(ridge + 2 * c * a.T @ a,
                               ridge @ w - 2 * c * a.T @ (y[active] - a @ w))
        size = 1.0
        while size > 1e-4 and cost(w - size * step) > cost(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-7:
            break
    return w


def _calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve of the margins, by Newton steps."""
    good, bad = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x, v = np.c_[margin, np.ones(len(margin))], np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2),
                               x.T @ (p - target))
        v = v - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(v[0]), float(v[1])


def held_out(id_col: str):
    """Rows that are never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of a batch that hold each word, toxic and clean ones."""
    hasher = Hasher(61)
    for batch in batches:
        toxic = np.asarray(batch.column("toxic"))
        for first, data, offsets in pieces(batch.column("text")):
            symbol, start, end, row = symbols(data, offsets)
            fit = (end - start > 2) & (end - start <= 40)
            start, end, row = start[fit], end[fit], row[fit]
            _, at, word = np.unique(hasher.slices(symbol, start, end),
                                    return_index=True, return_inverse=True)
            pairs = np.unique(np.stack([word, row], 1), axis=0) if len(word) else np.zeros((0, 2), int)
            bad = toxic[first + pairs[:, 1]]
            raw = symbol.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([raw[a:b] for a, b in zip(start[at], end[at])], pa.binary()),
                 pa.array(np.bincount(pairs[:, 0], bad, len(at)).astype(np.int64)),
                 pa.array(np.bincount(pairs[:, 0], 1 - bad, len(at)).astype(np.int64))],
                ["word", "bad", "good"])


def _members(candidates: list[bytes]):
    """Which candidate words each text holds."""
    where = {w: i for i, w in enumerate(candidates)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in pieces(batch.column("text")):
                symbol, start, end, row = symbols(data, offsets)
                raw, held = symbol.tobytes(), [set() for _ in range(len(offsets) - 1)]
                for a, b, r in zip(start.tolist(), end.tolist(), row.tolist()):
                    if (i := where.get(raw[a:b])) is not None:
                        held[r].add(i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([sorted(h) for h in held], pa.list_(pa.int32()))], ["held"])
    return run


def _chosen(held: list[list[int]], words: int, wanted: int) -> list[int]:
    """Words that cover the texts best, one after the other.

    A text counts a fifth for each word it is covered by, and a word has to bring a few
    texts in every thousand: so copies of one text don't bring all of its words in.
    """
    rows = [[] for _ in range(words)]
    for i, own in enumerate(held):
        for w in own:
            rows[w].append(i)
    rows = [np.array(r, np.int64) for r in rows]
    weight, chosen, enough = np.ones(len(held)), [], max(0.3, 0.001 * len(held))
    gain = np.array([float(len(r)) for r in rows])
    while len(chosen) < wanted and len(gain):
        best = int(gain.argmax())
        real = weight[rows[best]].sum()
        if gain[best] < enough:
            break
        if real < gain[best] - 1e-9:  # an old value: gains only fall
            gain[best] = real
        else:
            chosen.append(best)
            weight[rows[best]] *= 0.2
            gain[best] = -1
    return chosen


def _sums(rows: DataFrame, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Kernel values of the sampled texts with the words, and their labels as 1 and -1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = Kernel(words) if words else None
        for batch in batches:
            sums = kernel.documents(batch.column("text")) if kernel else np.zeros((batch.num_rows, 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums.astype("<f8")), pa.list_(pa.float64())), batch.column("toxic")],
                ["x", "toxic"])

    got = rows.mapInArrow(run, "x array<double>, toxic long").toArrow()
    y = np.where(np.asarray(got.column("toxic")) > 0, 1.0, -1.0)
    return np.asarray(got.column("x").combine_chunks().flatten()).reshape(len(y), len(words)), y


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        sample: int = SAMPLE, landmarks: int = LANDMARKS) -> Model:
    """Fits the classifier on at most ``sample`` labelled rows that aren't held out.

    Landmarks are words typical of toxic texts among them, chosen so that they cover
    these texts.  A text's Nyström features are its kernel values with the landmarks times
    the inverse root of the landmarks' own kernel matrix; a linear support vector machine
    on these, with a logistic curve over its margins, gives the score.
    """
    labelled = (labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull())
                .groupBy(F.col(id_col).alias("id")).agg(F.max("toxic").cast("long").alias("toxic"))
                .where(~held_out("id")).orderBy(F.xxhash64("id"), "id").limit(sample))
    rows = stored(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(labelled), "id").select("text", "toxic"), "sample")  # at most ``sample`` ids
    counts = rows.mapInArrow(_counted, "word binary, bad long, good long").groupBy("word").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    typical = [bytes(r.word) for r in counts.where("bad > 1 AND bad > 4 * good").orderBy(
        F.desc(F.col("bad") / (F.col("good") + 1)), "word").limit(20 * landmarks).collect()]
    held = [r.held for r in rows.where("toxic > 0").mapInArrow(
        _members(typical), "held array<int>").collect()]
    words = [typical[i] for i in _chosen(sorted(held), len(typical), landmarks)]
    x, y = _sums(rows, words)
    if words:  # words that clean texts resemble too tell nothing, and cost most
        bad, good = (x[y == side].mean(axis=0) if (y == side).any() else np.zeros(len(words)) for side in (1, -1))
        tell = bad > 4 * good
        words, x = [w for w, t in zip(words, tell) if t], x[:, tell]
    if not words or len(set(y)) < 2:
        share = (np.sum(y > 0) + 0.1) / (len(y) + 1)
        return Model([], np.zeros((0, 0)), np.zeros(1), 1.0, float(np.log(share / (1 - share))))
    kernel = Kernel(words)
    order = np.lexsort((*x.T, y))  # the rows' order in the cluster must not matter
    x, y = x[order], y[order]
    value, vector = np.linalg.eigh((kernel.square + kernel.square.T) / 2)
    root = 1 / np.sqrt(np.maximum(value, 0.05))
    project = (vector * root) @ vector.T
    x = np.log1p(x) @ project
    weights = _svm(x, y)
    slope, shift = _calibrate(x @ weights[:-1] + weights[-1], y)
    return Model(words, project, weights, slope, shift)


def score(docs: DataFrame, model: Model, text_col: str = "text", into: str = "score") -> DataFrame:
    """All columns of the rows, and the score of each whole text (0 to 1); null is empty.

    A column that is called like the score is replaced.
    """
    frame = docs.drop(into)
    names = frame.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = Kernel(model.landmarks) if model.landmarks else None
        for whole in batches:
            for first in range(0, whole.num_rows, 1000):  # what is held twice stays small
                batch = whole.slice(first, 1000)
                sums = kernel.documents(batch.column(at)) if kernel else np.zeros((batch.num_rows, 0))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(np.round(model.score(sums), 12))], [*names, into])

    return frame.mapInArrow(run, T.StructType([*frame.schema.fields, T.StructField(into, T.DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """``id_col``, ``held_out``, ``score`` and ``predicted`` (1 from ``threshold`` on) of each row.

    Null and empty texts have the score of a text without any word.  Rows without id are
    scored but not learned from; repeated rows are scored alike.  An id with several
    labels counts as toxic if one says so, null labels are left out; without labels of
    both kinds every text gets the share of toxic rows.  Other columns play no part.
    """
    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    model = fit(frame, labels.select(F.col(id_col).alias("id"), "toxic"), "id", "text")
    return score(frame, model).select(
        F.col("id").alias(id_col), held_out("id").alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
