"""Operator 8: perplexity under a Brown class-based bigram model.

Words are counted over all training texts. The `WORDS` commonest words stand
for themselves; every other word stands, at first, for a pool chosen by its
last bytes. Exchange clustering moves each word or pool to the class where the
likelihood of the class bigrams gains most, until none moves. Then each rarer
word leaves its pool for the class where its own neighbours gain most: the
classes before and after it are counted over all training texts, and the words
are placed in a distributed step, all by the same table of class bigrams. Only
words that no training text holds take the class of their pool. The model is

    P(text) = product of P(class | class before) * P(word | class)

with transitions, counted between the words' own classes, smoothed towards the
classes' own frequencies and add-one emissions that leave one share for unseen
words. A text starts after, and ends with, the end token, which is a class of
its own.

What is gathered: exact counts of all words, of all pairs of stand-ins, of the
neighbouring classes of all rarer words and of all pairs of classes, over every
training text. Only bounded tables reach the driver and the tasks: the
`WORDS + POOLS` square of pair counts, counts and classes of the `KNOWN`
commonest words, and the classes' totals. Rarer words meet the table of counts
and classes in a join.

Nulls: a null text is empty, so it has one token, the end. Rows are scored
each, also repeated ones; a null doc_id counts as the empty text for the fold.
With no training text at all every count is 0. Words of equal counts are
ranked by their bytes; of classes that gain the same a word takes the lowest. A
very long text is one row of a batch, with some 100 bytes for each of its
words. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import count, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeflow.llm.common import chunks, columns, commonest, fold, raw, table, written
from placeflow.llm.tokens import coded_words

WORDS, POOLS, CLASSES, KNOWN = 2400, 160, 80, 120_000
WEIGHT = 4.0
#: The end token, as a word (no word is empty).
END = b""
#: Distinct words that a task holds before it hands their counts on.
HELD = 250_000
#: Neighbours that a task holds before it hands their counts on.
HELD_PAIRS = 3_000_000
#: Counts of a rarer word: of the classes after it, of those before it, and of itself after itself.
WIDTH = 2 * (CLASSES + 1) + 1


def pool(word: bytes) -> int:
    return int(pools(pa.array([word], pa.large_binary()))[0])


def pools(words: pa.LargeBinaryArray) -> np.ndarray:
    """The pool of each word, by its last three bytes."""
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    out = np.zeros(len(words), np.int64)
    for back in (3, 2, 1):
        at = ends[1:] - back
        there = at >= ends[:-1]
        out[there] = out[there] * 257 + data[at[there]] + 1
    return out * 2_654_435_761 % 4_294_967_291 % POOLS


def _places(words: pa.LargeBinaryArray, listed: dict[bytes, int]) -> np.ndarray:
    """The place of each listed word, and for others their count plus their pool."""
    at = np.fromiter(map(listed.get, words.to_pylist(), repeat(-1)), np.int64, len(words))
    return np.where(at < 0, len(listed) + pools(words), at)


def _listed(words: list[bytes]) -> dict[bytes, int]:
    return dict(zip(words, range(len(words)), strict=True))


class _Ids(dict):
    """A number for each word, in the order in which they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = value = len(self)
        return value


def word_counts(docs: DataFrame) -> DataFrame:
    """word and n over all texts of docs (the end token is the empty word)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0

        def out() -> pa.RecordBatch:
            words = pa.chunked_array([w for w, _ in parts]).combine_chunks()
            sums = pa.table({"word": words, "n": np.concatenate([n for _, n in parts])}).group_by("word").aggregate([("n", "sum")]).combine_chunks()
            parts.clear()
            return pa.RecordBatch.from_arrays([sums.column("word").cast(pa.large_string()).cast(pa.string()).combine_chunks(), sums.column("n_sum").combine_chunks()], names=["word", "n"])

        for batch in chunks(batches, limit=2_500_000):
            texts = [(t or b"").lower() for t in raw(batch.column("text"))]
            words, codes, *_ = coded_words(texts)
            parts += [(words, np.bincount(codes, minlength=len(words))), (pa.array([END], pa.large_binary()), np.array([len(texts)]))]
            held += len(words)
            if held > 2 * HELD:
                yield out()
                held = 0
        if parts:
            yield out()

    return docs.select("text").mapInArrow(task, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _tokens(texts: list[bytes], places: dict, end: int) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Places of all tokens in a row (each text's end included), tokens of each text, the distinct words and the code of each word in a row."""
    words, codes, counts, *_ = coded_words([t.lower() for t in texts])
    at = _places(words, places)
    seq = np.full(len(codes) + len(texts), end, dtype=np.int64)
    seq[np.arange(len(codes)) + np.repeat(np.arange(len(texts)), counts)] = at[codes]
    return seq, counts + 1, words, codes


def pair_counts(docs: DataFrame, words: list[bytes]) -> np.ndarray:
    """Square matrix of neighbouring stand-ins (words, pools, end) over all texts of docs."""
    size = len(words) + POOLS + 1

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = _listed(words)
        total = np.zeros(size * size, dtype=np.int32)
        for batch in chunks(batches, limit=2_500_000):
            seq, *_ = _tokens([t or b"" for t in raw(batch.column("text"))], places, size - 1)
            before = np.concatenate([[size - 1], seq[:-1]])
            np.add.at(total, before * size + seq, 1)
        some = np.flatnonzero(total)
        for i in range(0, len(some), 200_000):
            part = some[i : i + 200_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part].astype(np.int64))], names=["pair", "n"])

    sums = docs.select("text").mapInArrow(task, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    got = sums.toArrow()  # `size` squared rows at most
    out = np.zeros(size * size)
    out[got.column("pair").to_numpy()] = got.column("n").to_numpy()
    return out.reshape(size, size)


def _h(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(pairs: np.ndarray, classes: int = CLASSES, sweeps: int | None = None) -> np.ndarray:
    """Class of each stand-in by exchange clustering of its pair counts, until none moves or for `sweeps` rounds; the last one (the end) has the last class alone."""
    n = len(pairs)
    order = np.argsort(-pairs.sum(axis=1), kind="stable")
    order = order[order != n - 1]
    own = np.empty(n, dtype=np.int64)
    own[order] = np.arange(n - 1) % classes
    own[n - 1] = classes
    hot = np.zeros((n, classes + 1))
    hot[np.arange(n), own] = 1
    right, left = pairs @ hot, pairs.T @ hot  # of each stand-in: counts of the classes after and before it
    g = hot.T @ right
    for _ in count() if sweeps is None else range(sweeps):
        moved = 0
        for w in order:
            r, c, self_n = right[w], left[w], pairs[w, w]
            if r.sum() + c.sum() == 0:
                continue
            a = own[w]
            # the table without w
            g[a] -= r
            g[:, a] -= c
            g[a, a] += self_n
            ra, ca = r.copy(), c.copy()
            ra[a] -= self_n
            ca[a] -= self_n
            # gain of putting w into each class: changed rows, columns, corners and margins
            rows = _h(g + ra) - _h(g)
            cols = _h(g + ca[:, None]) - _h(g)
            d = np.diagonal(g)
            gain = rows.sum(axis=1) + cols.sum(axis=0) - np.diagonal(rows) - np.diagonal(cols) + _h(d + ra + ca + self_n) - _h(d)
            # with w's neighbours, whatever its class: so each move gains, and the sweeps end
            rs, cs = g.sum(axis=1) + ca, g.sum(axis=0) + ra
            gain -= _h(rs + r.sum()) - _h(rs) + _h(cs + c.sum()) - _h(cs)
            b = int(gain[:classes].argmax())
            if gain[b] <= gain[a] + 1e-9:
                b = a
            g[b] += ra
            g[:, b] += ca
            g[b, b] += self_n
            if b != a:
                moved += 1
                own[w] = b
                right[:, a] -= pairs[:, w]
                right[:, b] += pairs[:, w]
                left[:, a] -= pairs[w]
                left[:, b] += pairs[w]
        if not moved:
            break
    return own


def chooser(g: np.ndarray):
    """The step of `exchange` for many words at once, each by itself: a function from their classes in the table g,
    the counts of classes after and before them, and the counts of themselves after themselves, to their best classes."""
    classes, few = len(g) - 1, 16
    sides = [(t, _h(t), np.stack([_h(t + n) - _h(t) for n in range(few)])) for t in (np.ascontiguousarray(g.T), g)]
    rs, cs, d = g.sum(axis=1), g.sum(axis=0), np.diagonal(g).copy()

    def choose(own: np.ndarray, after: np.ndarray, before: np.ndarray, same: np.ndarray) -> np.ndarray:
        i, n = np.arange(len(own)), after.sum(axis=1)
        # corners and margins
        gain = _h(d + after + before + same[:, None]) - _h(d)
        gain -= _h(rs + n[:, None]) - _h(rs) + _h(cs + n[:, None]) - _h(cs)
        stay = _h(d[own]) - _h(d[own] - after[i, own] - before[i, own] + same)
        stay -= _h(rs[own]) - _h(rs[own] - n) + _h(cs[own]) - _h(cs[own] - n)
        for (t, log_t, steps), x, y in zip(sides, (after, before), (before, after), strict=True):
            # neighbours of other classes than the word's
            w, k = np.nonzero(x)
            other = k != own[w]
            w, k = w[other], k[other]
            if len(w):
                c = x[w, k]
                step = steps[np.minimum(c, few - 1).astype(np.int64), k]
                many = np.flatnonzero(c >= few)
                step[many] = _h(t[k[many]] + c[many, None]) - log_t[k[many]]
                step[np.arange(len(k)), k] = 0
                first = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
                gain[w[first]] += np.add.reduceat(step, first)
            # neighbours of its class, which the word has left
            c = x[i, own] - same
            w = np.flatnonzero(c > 0)
            base = t[own[w]] - y[w]
            gain[w] += _h(base + c[w, None]) - _h(base)
            # and where it stays
            back = log_t.T[own] - _h(t.T[own] - x)
            back[i, own] = 0
            stay += back.sum(axis=1)
        gain[:, rs == 0] = -np.inf  # best for each word alone, so that unlike words would meet there
        gain[i, own] = stay
        best = gain[:, :classes].argmax(axis=1)
        return np.where(gain[i, best] > stay + 1e-9, best, own)

    return choose


def _blobs(ends: np.ndarray, data: np.ndarray) -> pa.Array:
    """Binary array of stretches of data; ends in bytes, from 0."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def rarer_words(docs: DataFrame, words: list[bytes], own: np.ndarray, g: np.ndarray) -> DataFrame:
    """word, n and class of every word of docs that isn't listed; own are the classes of the stand-ins, g is their table."""
    end = len(own) - 1

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, ids, keys = _listed(words), _Ids(), []

        def out() -> pa.RecordBatch:
            key, n = np.unique(np.concatenate(keys), return_counts=True)
            key = key.astype(np.int64)
            ends = np.searchsorted(key, np.arange(len(ids) + 1) * WIDTH) * 4
            rows = pa.RecordBatch.from_arrays([pa.array(list(ids), pa.binary()).cast(pa.string()), _blobs(ends, (n << 8 | key % WIDTH).astype("<u4"))], names=["word", "near"])
            ids.clear(), keys.clear()
            return rows

        for batch in chunks(batches, limit=2_500_000):
            seq, n, coded, codes = _tokens([t or b"" for t in raw(batch.column("text"))], places, end)
            at = np.flatnonzero((seq >= len(words)) & (seq < end))
            text_of = np.repeat(np.arange(len(n)), n)[at]
            codes = codes[at - text_of]
            met = np.unique(codes)
            number = np.zeros(len(coded), np.int64)
            number[met] = np.fromiter(map(ids.__getitem__, coded.take(pa.array(met)).to_pylist()), np.int64, len(met))
            num = number[codes]
            cls = own[seq]
            twice = (at[1:] == at[:-1] + 1) & (num[1:] == num[:-1])
            before = np.concatenate([[CLASSES], cls[:-1]])[at]
            keys += [x.astype(np.uint32) for x in (num * WIDTH + cls[at + 1], num * WIDTH + CLASSES + 1 + before, num[1:][twice] * WIDTH + WIDTH - 1)]
            if len(ids) > HELD or sum(map(len, keys)) > HELD_PAIRS:  # so few words that their numbers times WIDTH take 32 bits
                yield out()
        if ids:
            yield out()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        choose = chooser(g)

        def done(names: list[bytes], near: list[bytes]) -> pa.RecordBatch:
            new = np.array([True] + [x != y for x, y in zip(names[1:], names, strict=False)])
            names = [names[i] for i in np.flatnonzero(new).tolist()]
            packed = np.frombuffer(b"".join(near), "<u4")
            of = np.repeat(np.cumsum(new) - 1, [len(x) // 4 for x in near])
            full = np.bincount(of * WIDTH + (packed & 255), weights=packed >> 8, minlength=len(names) * WIDTH).reshape(len(names), WIDTH)
            after, before, same = full[:, : CLASSES + 1], full[:, CLASSES + 1 : -1], full[:, -1]
            homes = own[len(words) + pools(pa.array(names, pa.large_binary()))]
            best = [choose(homes[i : i + 1000], after[i : i + 1000], before[i : i + 1000], same[i : i + 1000]) for i in range(0, len(names), 1000)]
            return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()).cast(pa.string()), pa.array(after.sum(axis=1).astype(np.int64)), pa.array(np.concatenate(best), pa.int32())], names=["word", "n", "class"])

        names, near = [], []
        for batch in batches:
            names += raw(batch.column("word"))
            near += batch.column("near").to_pylist()
            # the last word may go on in the next batch
            cut = len(names)
            while cut and names[cut - 1] == names[-1]:
                cut -= 1
            if cut:
                yield done(names[:cut], near[:cut])
                names, near = names[cut:], near[cut:]
        if names:
            yield done(names, near)

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = docs.select("text").mapInArrow(neighbours, "word string, near binary")
    return near.repartition(n, "word").sortWithinPartitions("word").mapInArrow(place, "word string, n bigint, class int")


@dataclass
class Model:
    """What a task needs: known words with log10(count + 1), classes, and the smoothed tables as log10."""

    words: list[bytes]
    log_counts: np.ndarray
    classes: np.ndarray  # of the known words, then of the pools, then of the end
    moves: np.ndarray
    shares: np.ndarray  # log10 of tokens + distinct words + 1 of each class
    tokens: int
    distinct: int


def learn(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model of docs' texts, its moves still empty, and the table of all words with n and class."""
    docs = docs.select("text")
    counts = written(word_counts(docs))
    top = commonest(counts.filter("word <> ''"), "word", WORDS).toArrow()
    ends = counts.filter("word = ''").first()
    words = raw(top.column("word"))
    pairs = pair_counts(docs, words)
    own = exchange(pairs)
    hot = np.zeros((len(own), CLASSES + 1))
    hot[np.arange(len(own)), own] = 1
    listed = [(w.decode(), int(n), int(c)) for w, n, c in zip(words, top.column("n").to_pylist(), own, strict=False)]
    listed += [("", ends["n"], CLASSES)] if ends is not None else []
    rarer = rarer_words(docs, words, own, hot.T @ pairs @ hot)
    classed = written(rarer.unionAll(docs.sparkSession.createDataFrame(listed, "word string, n bigint, class int")))
    known = commonest(classed.filter("word <> ''"), "word", KNOWN).toArrow()
    classes = np.concatenate([known.column("class").to_numpy(), own[len(words) :]]).astype(np.int64)
    sums = classed.groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).toArrow()
    tokens, distinct = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
    tokens[sums.column("class").to_numpy()] = sums.column("n").to_numpy()
    distinct[sums.column("class").to_numpy()] = sums.column("v").to_numpy()
    logs = np.log10(known.column("n").to_numpy().astype(np.int64) + 1)
    return Model(raw(known.column("word")), logs, classes, np.empty((0, 0)), np.log10(tokens + distinct + 1), int(tokens.sum()), int(distinct.sum())), classed


def sequences(docs: DataFrame, model: Model, classed: DataFrame) -> DataFrame:
    """docs (doc_id, text) with n_tokens, n_known, log (sum of log10 of the words' counts + 1) and seq (a byte for each token, its class)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    ends = classed.filter("word = ''").first()
    end_log = float(np.log10((ends["n"] if ends else 0) + 1))
    end_known = int(ends is not None)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        places = _listed(m.words)
        listed = len(m.words)
        logs = np.concatenate([m.log_counts, np.zeros(POOLS), [end_log]])
        for batch in chunks(batches, limit=2_500_000):
            seq, n, coded, codes = _tokens([t or b"" for t in raw(batch.column("text"))], places, len(m.classes) - 1)
            first = np.cumsum(n) - n
            plain = np.add.reduceat(logs[seq], first)
            rare = (seq >= listed) & (seq < len(m.classes) - 1)
            known = n - np.add.reduceat(rare.astype(np.int64), first) - (1 - end_known)
            text_of = np.repeat(np.arange(len(n)), n)
            at = np.flatnonzero(rare)
            tails = coded.take(pa.array(codes[at - text_of[at]]))
            ends = np.concatenate([[0], np.cumsum(np.bincount(text_of[at], minlength=len(n)))]).astype(np.int32)
            tail = pa.ListArray.from_arrays(pa.array(ends), tails.cast(pa.large_string()).cast(pa.string()))
            spot = pa.ListArray.from_arrays(pa.array(ends), pa.array(at - first[text_of[at]], pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), pa.array(known), pa.array(plain), _blobs(np.append(first, n.sum()), m.classes[seq].astype(np.uint8)), spot, tail],
                names=["doc_id", "n_tokens", "known", "plain", "seq", "spot", "word"],
            )

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for seq, rare in zip(batch.column("seq").to_pylist(), batch.column("_put"), strict=True):
                if rare.is_valid:
                    code = rare.values.to_numpy()
                    own = np.frombuffer(seq, np.uint8).copy()
                    own[code >> 8] = code & 255
                    seq = own.tobytes()
                out.append(seq)
            kept = ["doc_id", "n_tokens", "n_known", "log"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(out, pa.binary())], names=[*kept, "seq"])

    local = docs.select("doc_id", "text").mapInArrow(task, "doc_id bigint, n_tokens bigint, known bigint, plain double, seq binary, spot array<int>, word array<string>")
    # the row numbers hold once they are written
    rows = written(local.withColumn("_row", F.monotonically_increasing_id()))
    rare = rows.select("_row", F.explode(F.arrays_zip("spot", "word")).alias("_t")).select("_row", "_t.spot", "_t.word")
    code = F.col("spot").cast("bigint") * 256 + F.col("class")
    met = rare.join(classed, "word").groupBy("_row").agg(F.count(F.lit(1)).alias("_known"), F.sum(F.log10(F.col("n") + 1)).alias("_log"), F.collect_list(code).alias("_put"))
    both = rows.drop("spot", "word").join(met, "_row", "left")
    whole = both.select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        (F.col("plain") + F.coalesce("_log", F.lit(0.0))).alias("log"), "seq", "_put",
    )
    return written(whole.mapInArrow(put, "doc_id bigint, n_tokens bigint, n_known bigint, log double, seq binary"))


def _steps(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of all tokens of a batch's sequences, those before them, and each sequence's first token (none is empty)."""
    seqs = batch.column("seq").to_pylist()
    own = np.frombuffer(b"".join(seqs), np.uint8).astype(np.int64)
    n = np.fromiter(map(len, seqs), np.int64, len(seqs))
    return own, np.concatenate([[CLASSES], own[:-1]]), np.cumsum(n) - n


def moved(model: Model, rows: DataFrame) -> Model:
    """The model with the transitions of the sequences of rows."""
    size = CLASSES + 1

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                own, before, _ = _steps(batch)
                total += np.bincount(before * size + own, minlength=size * size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["pair", "n"])

    got = rows.select("seq").mapInArrow(task, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    table_ = np.zeros(size * size)
    table_[got.column("pair").to_numpy()] = got.column("n").to_numpy()
    table_ = table_.reshape(size, size)
    # a class is entered as often as its tokens occur
    prior = (table_.sum(axis=0) + 1) / (table_.sum() + size)
    return replace(model, moves=np.log10((table_ + WEIGHT * prior) / (table_.sum(axis=1, keepdims=True) + WEIGHT)))


def fit(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model of docs' texts, and the table of all words with n and class."""
    model, classed = learn(docs)
    return moved(model, sequences(docs.select(F.lit(None).cast("bigint").alias("doc_id"), "text"), model, classed)), classed


def scored(docs: DataFrame, model: Model, classed: DataFrame) -> DataFrame:
    """docs (doc_id, text) with n_tokens, n_known, base_score and score."""
    return scores(sequences(docs, model, classed), model)


def scores(rows: DataFrame, model: Model) -> DataFrame:
    """The sequences of rows with base_score and score in place of log and seq."""
    moves, shares = model.moves, model.shares

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own, before, first = _steps(batch)
                part = np.add.reduceat(moves[before, own] - shares[own], first)
                kept = ["doc_id", "n_tokens", "n_known", "log"]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(part)], names=[*kept, "part"])

    share = float(np.log10(model.tokens + model.distinct + 1))
    both = rows.mapInArrow(task, "doc_id bigint, n_tokens bigint, n_known bigint, log double, part double")
    return both.select("doc_id", "n_tokens", "n_known", (F.col("log") - F.col("n_tokens") * F.lit(share)).alias("base_score"), (F.col("log") + F.col("part")).alias("score"))


def op8_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = columns(table(spark, sf_dir, "documents"), "doc_id", "text")
    trains = fold(F.col("doc_id"), 7) != 2
    model, classed = learn(docs.filter(trains))
    rows = sequences(docs, model, classed)
    model = moved(model, rows.filter(trains))
    out = scores(rows, model)
    return out.select(
        "doc_id", (fold(F.col("doc_id"), 7) == 2).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
