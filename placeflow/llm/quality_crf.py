"""Operator 7: quality of documents from a linear-chain conditional random field over lines.

Every line is good (1) or bad (0). A line's emission score is linear in its own
features and those of the lines before and after it; neighbouring labels have a
2 x 2 transition score. Forward-backward gives each line's marginal, and the
mean of the marginals, weighted by line length, is the document's quality.

Training maximises the conditional likelihood with every line carrying its
document's label (Adam over all sampled documents at once, a penalty on squared
weights). It uses a bounded sample: the `SAMPLE` labelled documents with the
least hash of doc_id among those allowed, and of each `RUNS` stretches of `RUN`
neighbouring lines, spread over the text. Features are made of whole texts,
where the texts are; only the stretches' features reach the driver. Scoring
reads whole texts.

A null text is one empty line, as is an empty one. Documents without a label
don't train; without any label, or with one class only, all weights stay 0 and
every score is 0.5. If a document has several labels the largest counts. Rows
are judged alone, so repeated rows get the same score; of several texts with
one doc_id one trains. A score of exactly 0.5 predicts 1. A very long text is
one row of a batch, with some 60 bytes for each of its lines (measured: 224 MB for
four million line ends, which took four and a half minutes on a busy core):
features and messages are held for some 65,000 lines at a time. An empty table
gives no rows; extra columns are ignored by `score` and kept by `keep`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeflow.llm.common import chunks, columns, fold, least, raw, table
from placeflow.llm.tokens import mix

SAMPLE, RUNS, RUN = 3000, 3, 16
STEPS, RATE, PENALTY = 250, 0.1, 1e-3

_CLASSES = (
    b"#*$%&|<>~^={}[]\\_@+",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"abcdefghijklmnopqrstuvwxyz",
    b"0123456789",
    b"!?",
    b".,;:",
    b" \t\x0b\x0c\r",
)
_TABLES = np.zeros((len(_CLASSES), 256), dtype=np.uint8)
for _i, _c in enumerate(_CLASSES):
    _TABLES[_i, list(_c)] = 1
OWN = 14
#: Lines whose features, and messages, are held at once.
SLICE = 1 << 16
WIDTH = 3 * OWN


@dataclass
class Lines:
    """The lines of some texts: the bytes, where each line starts and ends, how many each text has, and which repeat an earlier one."""

    whole: bytes
    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray
    again: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Lines:
        counts = np.array([t.count(b"\n") + 1 for t in texts], dtype=np.int64)
        whole = b"\n".join(texts) + b"\n"
        ends = np.flatnonzero(np.frombuffer(whole, np.uint8) == 10)
        starts = np.append(0, ends[:-1] + 1)
        hashes = np.empty(len(ends), np.uint64)
        for a in range(0, len(ends), SLICE):
            b = min(len(ends), a + SLICE)
            hashes[a:b] = [xxhash.xxh3_64_intdigest(line) for line in whole[starts[a] : ends[b - 1]].split(b"\n")]
        hashes ^= np.repeat(mix(np.arange(len(texts), dtype=np.uint64)), counts)  # equal lines of one text only
        again = np.ones(len(ends), dtype=bool)
        again[np.unique(hashes, return_index=True)[1]] = False
        return cls(whole, starts, ends, counts, again & (ends > starts))

    def features(self) -> Iterator[tuple[int, np.ndarray]]:
        """Number of the first line and own features [lines, OWN] of SLICE lines at a time."""
        for a in range(0, len(self.ends), SLICE):
            b = min(len(self.ends), a + SLICE)
            yield a, _own(self.whole[self.starts[a] : self.ends[b - 1] + 1], self.starts[a:b] - self.starts[a], self.ends[a:b] - self.starts[a], self.again[a:b])

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Whether each line is the first, and the last, of its text."""
        first, last = np.zeros(len(self.ends), dtype=bool), np.zeros(len(self.ends), dtype=bool)
        upto = np.cumsum(self.counts)
        first[upto - self.counts], last[upto - 1] = True, True
        return first, last


def _own(part: bytes, starts: np.ndarray, ends: np.ndarray, again: np.ndarray) -> np.ndarray:
    b = np.frombuffer(part, np.uint8)
    size = (ends - starts).astype(np.float64)
    sums = [np.add.reduceat(t[b], starts, dtype=np.int64) for t in _TABLES]
    blank = (_TABLES[-1][b] == 1) | (b == 10)
    word = ~blank
    word[1:] &= blank[:-1]
    words = np.add.reduceat(word, starts, dtype=np.int64)
    distinct = np.fromiter((len(set(line.split())) for line in part[:-1].split(b"\n")), np.int64, len(ends))
    last = b[np.maximum(ends - 1, 0)]
    symbol, upper, lower, digit, shout, point, _ = (s / np.maximum(size, 1) for s in sums)
    x = np.empty((len(ends), OWN))
    x[:, 0] = 1
    x[:, 1] = np.log1p(size) / 5
    x[:, 2] = symbol * 5
    x[:, 3] = symbol > 0.03
    x[:, 4] = upper * 3
    x[:, 5] = upper > 0.4
    x[:, 6] = digit * 5
    x[:, 7] = shout * 10
    x[:, 8] = point * 10
    x[:, 9] = size / np.maximum(words, 1) / 10
    x[:, 10] = 1 - distinct / np.maximum(words, 1)
    x[:, 11] = again
    x[:, 12] = np.isin(last, np.frombuffer(b".!?\"", np.uint8)) & (size > 0)
    x[:, 13] = words < 3
    return np.minimum(x, 10, out=x)


def line_features(lines: Lines, wanted: np.ndarray) -> np.ndarray:
    """Features [wanted, WIDTH] of the lines with these numbers (in order): their own, and those of the lines before and after them in the text."""
    near = np.unique(np.concatenate([wanted, wanted - 1, wanted + 1]).clip(0, len(lines.ends) - 1))
    own = np.empty((len(near), OWN))
    for a, x in lines.features():
        i, j = np.searchsorted(near, (a, a + len(x)))
        own[i:j] = x[near[i:j] - a]
    at = np.searchsorted(near, wanted)
    first, last = (e[wanted] for e in lines.edges())
    prior = own[np.maximum(at - 1, 0)] * ~first[:, None]
    after = own[np.minimum(at + 1, len(near) - 1)] * ~last[:, None]
    return np.hstack([own[at], prior, after])


def emissions(lines: Lines, weights: np.ndarray) -> np.ndarray:
    """Scores of all lines, as `line_features @ weights`: three products of each line's own features, shifted."""
    own, prior, after = weights.reshape(3, OWN)
    s, as_prior, as_after = (np.empty(len(lines.ends)) for _ in range(3))
    for a, x in lines.features():
        s[a : a + len(x)], as_prior[a : a + len(x)], as_after[a : a + len(x)] = x @ own, x @ prior, x @ after
    first, last = lines.edges()
    s[1:] += np.where(first[1:], 0, as_prior[:-1])
    s[:-1] += np.where(last[:-1], 0, as_after[1:])
    return s


@dataclass
class Field:
    """Weights of the label "good" and the transition scores [from, to]."""

    weights: np.ndarray
    moves: np.ndarray

    def marginals(self, s: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(good) [D, T] and the summed pair marginals [D, 2, 2] of padded emission scores s [D, T] of lengths n.

        Goes over SLICE lines at a time: the forward messages at the slices'
        heads are kept, those within a slice made again on the way back.
        """
        d, t = s.shape
        m = np.exp(self.moves - self.moves.max())

        def forward(a: int, before: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
            """Weights and messages of the slice at a."""
            part = s[:, a : a + SLICE]
            top = np.maximum(part, 0)
            e = np.stack([np.exp(-top), np.exp(part - top)], axis=2)
            out, now = np.empty(e.shape), before
            for i in range(e.shape[1]):
                now = e[:, 0] if now is None else np.where((a + i < n)[:, None], (now @ m) * e[:, i], now)
                now = now / now.sum(axis=1, keepdims=True)
                out[:, i] = now
            return e, out

        heads: list[np.ndarray | None] = [None]
        for a in range(0, t - SLICE, SLICE):
            heads.append(forward(a, heads[-1])[1][:, -1])
        p, pairs = np.zeros((d, t)), np.zeros((d, 2, 2))
        back = np.ones((d, 2))
        for k in range(len(heads) - 1, -1, -1):
            a = k * SLICE
            e, f = forward(a, heads[k])
            for i in range(e.shape[1] - 1, -1, -1):
                q = f[:, i] * back
                p[:, a + i] = q[:, 1] / q.sum(axis=1)
                if a + i:
                    live = (a + i < n)[:, None]
                    right = e[:, i] * back
                    joint = (f[:, i - 1] if i else heads[k])[:, :, None] * m * right[:, None, :]
                    joint /= joint.sum(axis=(1, 2), keepdims=True)
                    pairs += np.where(live[:, :, None], joint, 0)
                    fresh = right @ m.T
                    back = np.where(live, fresh / fresh.sum(axis=1, keepdims=True), back)
        return p, pairs


def _groups(counts: np.ndarray, cells: int = 200_000) -> Iterator[np.ndarray]:
    """Texts of like length together, so that padding stays small."""
    order = np.argsort(counts, kind="stable")
    i = 0
    while i < len(order):
        j = i + 1
        while j < len(order) and (j + 1 - i) * counts[order[j]] <= cells and counts[order[j]] <= 2 * counts[order[i]] + 4:
            j += 1
        yield order[i:j]
        i = j


def _rows(counts: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Line numbers [D, T] of the texts of a group (padding repeats the last line), and their lengths."""
    n = counts[group]
    first = (np.cumsum(counts) - counts)[group]
    return first[:, None] + np.minimum(np.arange(n.max()), n[:, None] - 1), n


def train(x: np.ndarray, counts: np.ndarray, y: np.ndarray, steps: int = STEPS) -> Field:
    """x: line features; counts: lines of each text; y: label of each text."""
    f = Field(np.zeros(x.shape[1]), np.zeros((2, 2)))
    if len(set(y.tolist())) < 2:
        return f
    groups = [(g, *_rows(counts, g)) for g in _groups(counts)]
    m = [np.zeros_like(f.weights), np.zeros_like(f.moves)]
    v = [np.zeros_like(f.weights), np.zeros_like(f.moves)]
    for step in range(1, steps + 1):
        gw, gm = -PENALTY * f.weights, -PENALTY * f.moves
        for g, rows, n in groups:
            p, pairs = f.marginals((x @ f.weights)[rows], n)
            live = np.arange(rows.shape[1]) < n[:, None]
            share = 1 / n / len(y)
            gw = gw + np.einsum("dt,dtf->f", (y[g][:, None] - p) * live * share[:, None], x[rows])
            true = np.zeros_like(pairs)
            true[np.arange(len(g)), y[g], y[g]] = n - 1
            gm = gm + ((true - pairs) * share[:, None, None]).sum(axis=0)
        for w, g, a, b in ((f.weights, gw, m[0], v[0]), (f.moves, gm, m[1], v[1])):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            w += RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-9)
    return f


def quality(f: Field, texts: list[bytes]) -> np.ndarray:
    """Length-weighted mean of the lines' marginals of each text."""
    if not texts:
        return np.empty(0)
    lines = Lines.of(texts)
    s, out = emissions(lines, f.weights), np.empty(len(texts))
    for g in _groups(lines.counts):
        rows, n = _rows(lines.counts, g)
        p, _ = f.marginals(s[rows], n)
        w = (lines.ends[rows] - lines.starts[rows] + 1.0) * (np.arange(rows.shape[1]) < n[:, None])
        out[g] = (p * w).sum(axis=1) / w.sum(axis=1)
    return np.clip(out, 0, 1)


def stretches(lines: int, runs: int = RUNS, run: int = RUN) -> list[tuple[int, int]]:
    """First and last line (exclusive) of up to `runs` stretches, evenly spaced: the head, the foot and between them."""
    if lines <= runs * run:
        return [(0, lines)]
    return [(a, a + run) for a in (round(i * (lines - run) / max(1, runs - 1)) for i in range(runs))]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field:
    """A field from labels (doc_id, quality) and the texts of docs."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            lines = Lines.of([t or b"" for t in raw(batch.column("text"))])
            cut = [[(first + a, b - a) for a, b in stretches(n)] for first, n in zip((np.cumsum(lines.counts) - lines.counts).tolist(), lines.counts.tolist(), strict=True)]
            x = line_features(lines, np.concatenate([np.arange(a, a + n) for own in cut for a, n in own])).astype("<f4")
            rows, at = [], 0
            for key, quality_, own in zip(batch.column("doc_id").to_pylist(), batch.column("quality").to_pylist(), cut, strict=True):
                for i, (_, n) in enumerate(own):
                    rows.append((key, quality_, i, n, x[at : at + n].tobytes()))
                    at += n
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "quality", "run", "n", "x"])

    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    some = known.filter(least(known, "doc_id", sample))
    # some `sample` rows of two numbers; and as many times RUNS stretches
    cut = docs.join(F.broadcast(some), "doc_id").select("doc_id", "quality", "text").mapInArrow(task, "doc_id bigint, quality int, run int, n int, x binary")
    rows = cut.groupBy("doc_id", "run").agg(F.max(F.struct("quality", "n", "x")).alias("r")).select("doc_id", "run", "r.*").orderBy("doc_id", "run").toArrow()
    if not rows.num_rows:
        return Field(np.zeros(WIDTH), np.zeros((2, 2)))
    x = np.frombuffer(b"".join(rows.column("x").to_pylist()), "<f4").astype(np.float64).reshape(-1, WIDTH)
    return train(x, rows.column("n").to_numpy().astype(np.int64), (rows.column("quality").to_numpy() > 0).astype(np.int64))


def scored(docs: DataFrame, f: Field) -> DataFrame:
    """doc_id and score of every document."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=4_000_000):
            score = quality(f, [t or b"" for t in raw(batch.column("text"))])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return columns(docs, "doc_id", "text").mapInArrow(task, "doc_id bigint, score double")


def keep(docs: DataFrame, f: Field, least: float = 0.5) -> DataFrame:
    """docs that score `least` or more."""

    @F.pandas_udf(T.DoubleType())
    def rate(texts: pd.Series) -> pd.Series:
        out = [quality(f, [t.encode() if t else b"" for t in texts[i : i + 1000]]) for i in range(0, len(texts), 1000)]
        return pd.Series(np.concatenate(out) if out else np.empty(0))

    return docs.filter(rate("text") >= least)


def learn(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> Field:
    docs = table(spark, sf_dir, "documents") if docs is None else docs
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").filter(fold(F.col("doc_id"), 3) != 1)
    return fit(columns(docs, "doc_id", "text"), labels)


def op7_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scored(table(spark, sf_dir, "documents"), learn(spark, sf_dir))
    return out.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
