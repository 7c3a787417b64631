"""Operator 1: language of whole texts by a bidirectional gated recurrent network over bytes.

The network reads a text's bytes, all of them, and labels every position. The
state goes on across words. Texts are read in windows of `WINDOW` bytes, each
with `MARGIN` bytes of its neighbours on either side, over which the states of
both directions warm up; windows begin at whole characters. A position is
judged in one window only. A document's probability of a language is the mean
over its letters' bytes: ASCII letters and all bytes of other characters.

Training runs in numpy by backpropagation through time (Adam), on windows drawn
from a bounded sample of labelled documents: the `SAMPLE` documents with the
least hash of doc_id among those allowed, `DRAWN` windows of `LENGTH` bytes of
each, evenly spaced, cut out where the texts are. The weights (some twenty
thousand numbers) go to the tasks with the function.

Nulls: a null text, or one without a letter, is `und` with score 0. Documents
without a label don't train; if no document has one, every answer is `und`.
Equal probabilities go to the language that comes first by name. Rows are
judged alone, so repeated rows get the same answer. Of a very long text some
twenty bytes are held for each of its own. An empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeflow.llm.common import chunks, columns, fold, least, raw, table

HIDDEN, WINDOW, MARGIN = 20, 1024, 64
SAMPLE, DRAWN, LENGTH = 2000, 8, 96
STEPS, BATCH, RATE = 320, 192, 0.02
#: Windows that are read at once, and steps whose outputs are one product.
LANES, STRETCH = 1000, 8
UNKNOWN = "und"

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Weights: byte inputs [2, 256, 3H], recurrent [2, H, 3H], outputs [2H, L] and biases; 2 directions.

    Lanes (columns of the byte rows x [T, B]) come with the longest first;
    lane b has live[t] > b at each of its positions t.
    """

    names: list[str]
    inputs: np.ndarray
    hidden: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    @classmethod
    def fresh(cls, names: list[str], h: int = HIDDEN, seed: int = 5) -> Network:
        r = np.random.default_rng(seed)
        new = lambda *s: (r.standard_normal(s) * 0.25).astype(np.float32)
        return cls(names, new(2, 256, 3 * h), new(2, h, 3 * h), new(2 * h, len(names)), np.zeros(len(names), np.float32))

    def weights(self) -> list[np.ndarray]:
        return [self.inputs, self.hidden, self.output, self.bias]

    def blocks(self, x: np.ndarray, live: list[int]) -> Iterator[tuple[int, int, np.ndarray]]:
        """Scores [.., B, L] before the softmax of positions from .. to, the last ones first; the bias beyond a lane.

        A block's states are kept, so that its outputs are one product, and
        what is made of a block is still in the cache.
        """
        t, b = x.shape
        h, n = self.hidden.shape[1], len(self.names)
        out = np.empty((t, b, n), np.float32)
        a, u, states = np.empty((3, b, h), np.float32), np.empty((3, b, h), np.float32), np.empty((STRETCH + 1, b, h), np.float32)
        half = np.array([0.5, 0.5, 1], np.float32)[:, None, None]  # a sigmoid is half of one more than the tanh of half its argument
        firsts = range(0, t, STRETCH)
        for d in (0, 1):
            # gates and candidate apart, so that every step works on stretches of memory
            into = np.ascontiguousarray(self.inputs[d].reshape(256, 3, h).transpose(1, 0, 2)) * half
            on = np.ascontiguousarray(self.hidden[d].reshape(h, 3, h).transpose(1, 0, 2)) * np.float32(0.5)
            final = np.ascontiguousarray(self.output[d * h : (d + 1) * h])
            states[:] = 0
            k = -1
            for low in firsts if d == 0 else reversed(firsts):
                high, most = min(low + STRETCH, t), live[low]
                for j, i in enumerate(range(low, high) if d == 0 else range(high - 1, low - 1, -1)):
                    if live[i] != k:
                        k = live[i]
                        ins, recurrent, gate, fresh, added, cand = a[:, :k], u[:, :k], u[:2, :k], u[2, :k], a[:2, :k], a[2, :k]
                        update, reset = gate
                    now = states[j, :k]
                    np.take(into, x[i, :k], axis=1, out=ins, mode="clip")
                    np.matmul(now, on, out=recurrent)
                    gate += added
                    np.tanh(gate, out=gate)
                    gate += 1
                    fresh *= reset
                    fresh += cand
                    np.tanh(fresh, out=fresh)
                    fresh -= now
                    update *= 0.5
                    fresh *= update
                    np.add(now, fresh, out=states[j + 1, :k])
                    states[j + 1, k:most] = 0
                said = states[1 : high - low + 1, :most] @ final
                if d == 0:
                    out[low:high, :most], out[low:high, most:] = said, 0
                else:
                    block = out[low:high]
                    block[:, :most] += said[::-1]
                    block += self.bias
                    yield low, high, block
                states[0] = states[high - low]

    def scores(self, x: np.ndarray, live: list[int]) -> np.ndarray:
        """Scores [T, B, L] before the softmax; the bias beyond a lane."""
        out = np.empty((*x.shape, len(self.names)), np.float32)
        for low, high, block in self.blocks(x, live):
            out[low:high] = block
        return out

    def sums(self, x: np.ndarray, live: list[int], judged: np.ndarray) -> np.ndarray:
        """Probabilities of the languages [B, L], summed over the judged positions [T, B] of each lane."""
        total, ones = np.zeros((x.shape[1], len(self.names))), np.ones(len(self.names), np.float32)
        for low, high, block in self.blocks(x, live):
            e = np.exp(np.clip(block, -60, 60, out=block), out=block)
            total += np.einsum("tbl,tb->bl", e, judged[low:high] / (e @ ones))
        return total

    def probabilities(self, x: np.ndarray, live: list[int]) -> np.ndarray:
        """Probabilities [T, B, L] of the languages at every position; those beyond a lane mean nothing."""
        e = np.exp(np.clip(self.scores(x, live), -60, 60))
        return e / e.sum(axis=2, keepdims=True)

    def gradients(self, x: np.ndarray, live: list[int], y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean loss over positions and its gradients, by backpropagation through time."""
        t, b = x.shape
        h = self.hidden.shape[1]
        states, kept = np.zeros((t, b, 2 * h), np.float32), []
        for d in (0, 1):
            state, steps = np.zeros((b, h), np.float32), [None] * t
            for i in range(t) if d == 0 else range(t - 1, -1, -1):
                k = live[i]
                now = state[:k].copy()
                a, u = self.inputs[d][x[i, :k]], now @ self.hidden[d]
                gate = _sigmoid(a[:, : 2 * h] + u[:, : 2 * h])
                z, r = gate[:, :h], gate[:, h:]
                c = np.tanh(a[:, 2 * h :] + r * u[:, 2 * h :])
                steps[i] = (now, z, r, c, u[:, 2 * h :])
                state[:k] = now + z * (c - now)
                states[i, :k, d * h : (d + 1) * h] = state[:k]
            kept.append(steps)
        mask = (np.arange(b) < np.array(live)[:, None]).astype(np.float32)
        count = mask.sum()
        score = states @ self.output + self.bias
        score -= score.max(axis=2, keepdims=True)
        p = np.exp(score)
        p /= p.sum(axis=2, keepdims=True)
        lanes = np.arange(b)
        loss = -(np.log(np.maximum(p[:, lanes, y], 1e-9)) * mask).sum() / count
        p[:, lanes, y] -= 1
        err = p * mask[:, :, None] / count
        g_out = states.reshape(-1, 2 * h).T @ err.reshape(-1, err.shape[2])
        d_states = err @ self.output.T
        g_in, g_hid = np.zeros_like(self.inputs), np.zeros_like(self.hidden)
        for d in (0, 1):
            carry, whole = np.zeros((b, h), np.float32), np.zeros((t, b, 3 * h), np.float32)
            for i in range(t - 1, -1, -1) if d == 0 else range(t):
                k = live[i]
                state, z, r, c, uc = kept[d][i]
                own = carry[:k] + d_states[i, :k, d * h : (d + 1) * h]
                dc = own * z * (1 - c * c)
                dz = own * (c - state) * z * (1 - z)
                dr = dc * uc * r * (1 - r)
                whole[i, :k] = np.concatenate([dz, dr, dc], axis=1)
                du = np.concatenate([dz, dr, dc * r], axis=1)
                g_hid[d] += state.T @ du
                carry[:k] = own * (1 - z) + du @ self.hidden[d].T
            np.add.at(g_in[d], x.ravel(), whole.reshape(-1, 3 * h))
        return float(loss), [g_in, g_hid, g_out.astype(np.float32), err.sum(axis=(0, 1))]


def lanes(parts: list[bytes]) -> tuple[np.ndarray, list[int], np.ndarray]:
    """Byte rows x [T, B] of the parts, the longest first, live lanes at each position, and the part of each lane."""
    n = np.fromiter(map(len, parts), np.int64, len(parts))
    order = np.argsort(-n, kind="stable")
    x, live = _lanes(np.frombuffer(b"".join(parts), np.uint8), (np.cumsum(n) - n)[order], n[order])
    return x, live, order


def _lanes(buf: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, list[int]]:
    rows = np.zeros((len(n), n[0] if len(n) else 0), np.uint8)
    for row, a, k in zip(rows, first.tolist(), n.tolist(), strict=True):
        row[:k] = buf[a : a + k]
    return np.ascontiguousarray(rows.T), np.searchsorted(-n, -np.arange(rows.shape[1]), side="left").tolist()


def train(parts: list[bytes], labels: np.ndarray, names: list[str], steps: int = STEPS, seed: int = 3) -> Network:
    """Adam over batches that hold every language equally often."""
    r = np.random.default_rng(seed)
    net = Network.fresh(names)
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in net.weights()]
    pools = [np.flatnonzero(labels == k) for k in range(len(names))]
    for step in range(1, steps + 1):
        pick = np.concatenate([r.choice(p, max(1, BATCH // len(names))) for p in pools])
        x, live, order = lanes([parts[i] for i in pick])
        _, grads = net.gradients(x, live, labels[pick][order])
        rate = RATE * (1 - step / (steps + 1))
        for w, g, (m, v) in zip(net.weights(), grads, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return net


def windows(sizes: np.ndarray, buf: np.ndarray) -> tuple[np.ndarray, ...]:
    """Windows over texts of these sizes that lie in buf in a row: text, first and end byte read, first and end byte judged."""
    count = np.maximum(1, -(-sizes // WINDOW))
    text = np.repeat(np.arange(len(sizes)), count)
    first = (np.cumsum(sizes) - sizes)[text]
    low = first + (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * WINDOW
    stop = first + sizes[text]

    def whole(at: np.ndarray) -> np.ndarray:
        """The character that a place lies in begins within three bytes before."""
        at = np.clip(at, first, stop)
        for _ in range(3):
            inside = at < stop
            inside[inside] = (buf[at[inside]] & 0xC0) == 0x80
            at = np.maximum(at - inside, first)
        return at

    high = np.where(low + WINDOW < stop, whole(low + WINDOW), stop)
    low = whole(low)
    return text, whole(low - MARGIN), whole(high + MARGIN), low, high


def label(net: Network, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Mean probabilities [texts, languages] over the letters' bytes, and whether a text has a letter."""
    sums, count = np.zeros((len(texts), len(net.names))), np.zeros(len(texts))
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    buf = np.frombuffer(b"".join(texts), np.uint8)
    text, begin, end, low, high = windows(sizes, buf)
    order = np.argsort(begin - end, kind="stable")
    for i in range(0, len(order), LANES):
        part = order[i : i + LANES]
        n = (end - begin)[part]
        x, live = _lanes(buf, begin[part], n)
        if not len(x):
            continue
        judged = _LETTER[x]
        for lane, a, b in zip(judged.T, (low - begin)[part].tolist(), (high - begin)[part].tolist(), strict=True):
            lane[:a] = lane[b:] = False
        np.add.at(sums, text[part], net.sums(x, live, judged))
        np.add.at(count, text[part], judged.sum(axis=0))
    known = np.fromiter(map(_has_letter, texts), bool, len(texts))
    return sums / np.maximum(count, 1)[:, None], known & (count > 0)


def _has_letter(text: bytes) -> bool:
    return text[:1].isalpha() or any(map(str.isalpha, text.decode()))


def positions(net: Network, text: bytes) -> list[str]:
    """The label of every byte of a text."""
    buf = np.frombuffer(text, np.uint8)
    out = np.zeros(len(buf), np.int64)
    _, begin, end, low, high = windows(np.array([len(buf)]), buf)
    for b, e, lo, hi in zip(begin, end, low, high, strict=True):
        if e > b:
            p = net.probabilities(buf[b:e, None], [1] * (e - b))[:, 0]
            out[lo:hi] = p.argmax(axis=1)[lo - b : hi - b]
    return [net.names[i] for i in out]


def drawn(text: bytes, count: int = DRAWN, length: int = LENGTH) -> list[bytes]:
    """Up to `count` stretches of a text, evenly spaced, that begin at whole characters."""
    starts = sorted({int(i) for i in np.linspace(0, max(0, len(text) - length), count)})
    out = []
    for a in starts:
        while a and text[a] & 0xC0 == 0x80:
            a -= 1
        out.append(text[a : a + length])
    return [x for x in out if x]


def fit(docs: DataFrame, sample: int = SAMPLE, count: int = DRAWN) -> Network | None:
    """A network for the labels of docs (doc_id, text, lang); None without labels."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [drawn(t, count) for t in raw(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array(parts, pa.list_(pa.binary()))], names=["doc_id", "lang", "parts"])

    known = docs.filter("lang IS NOT NULL AND text IS NOT NULL")
    cut = known.filter(least(known, "doc_id", sample)).select("doc_id", "text", "lang").mapInArrow(task, "doc_id bigint, lang string, parts array<binary>")
    rows = cut.dropDuplicates(["doc_id"]).orderBy("doc_id").toArrow().to_pylist()  # `sample` rows of `count` stretches at most
    parts = [p for r in rows for p in r["parts"]]
    labels = [r["lang"] for r in rows for _ in r["parts"]]
    if not parts:
        return None
    names = sorted(set(labels))
    index = {n: i for i, n in enumerate(names)}
    return train(parts, np.array([index[x] for x in labels]), names)


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """docs (doc_id, text) with lang_pred and score."""
    if net is None:
        return docs.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=4_000_000):
            p, known = label(net, [t or b"" for t in raw(batch.column("text"))])
            best = p.argmax(axis=1)
            names = [net.names[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)]
            score = np.where(known, p[np.arange(len(p)), best], 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(np.clip(score, 0, 1))], names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(task, "doc_id bigint, lang_pred string, score double")


def op1_byte_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = columns(table(spark, sf_dir, "documents"), "doc_id", "text", "lang")
    net = fit(docs.filter(fold(F.col("doc_id"), 5) != 0))
    return predict(docs, net).select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")
