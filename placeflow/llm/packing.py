"""Operator 5: vector bin packing of documents into training sequences.

Pieces of tokenised documents are placed into sequences under three limits at
once: tokens, segments (pieces) and loss-bearing tokens. The placing is the
dot-product heuristic: of the waiting pieces that fit into the open sequence,
take the one whose demand vector has the largest weighted dot product with the
sequence's remaining room, the weights being the mean demand in each dimension.
When nothing fits whole, the piece with the largest product among those of which
a part fits is cut to fill the room. Equal products go to the piece that waits
longest.

Which tokens bear loss is a rule, as in instruction data: the prompt of a
document, its first line that has a word (if words follow it), bears none, the
rest and the end id do. With `loss_column` a row bears loss in all its tokens or
in none, as turns of a conversation do by their role. A sequence holds at most
`LOSS` loss-bearing tokens, so the last `TOKENS - LOSS` places of a full one
hold tokens of prompts, its own or those of waiting documents.

Each task packs its own rows as they stream by and at most `POOL` pieces wait,
so memory is bounded (by the longest text, whose ids are held at once) and
nothing is shuffled. What remains open at a task's end is cut at powers of two,
down to `LEAST`, since a sequence whose length is a power of two needs no
padding. Sequence ids are the task's partition number times 2**40 plus a
counter; a rerun task makes the same ones.

A null text counts as empty: its document is the end id alone. An empty table
gives no rows. Repeated rows are packed each. Extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeflow.llm.common import chunks, columns, raw, table
from placeflow.llm.tokens import coded_words

TOKENS, SEGMENTS, LOSS = 2048, 512, 1984
END = 1
#: Waiting remainders, and the smallest power of two that a task's last sequences are cut to.
POOL, LEAST = 768, 32
#: Distinct words whose ids a worker keeps.
MEMO = 300_000

_NAMES = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "n_loss")
SCHEMA = ", ".join(f"{n} bigint" for n in _NAMES)


#: The split rule (a fixed value) under which a text's words can be cut as `coded_words` does: contractions, letters, single numbers, other marks.
RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: What marks the last piece of a run under that rule.
SUFFIX = "</w>"


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves, the others from U+0100 on in a row."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds:
    """Token ids of whole texts under a tokenizer that never joins two words.

    The tokenizer drops ASCII blanks and splits at them before merging, so a
    text's ids are its words' ids in a row, and each distinct word is encoded
    once. Under `RULE`, simple words are cut further and made lower case
    beforehand; only the merges are left to do, and each run's last id is one
    of a piece that ends in `SUFFIX`.
    """

    LINE = 400

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        kind = json.loads(self.tokenizer.to_str())
        steps = [n["type"] for n in (kind["normalizer"] or {}).get("normalizers", [])]
        splits = [p.get("pattern", {}).get("Regex") for p in (kind["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.parts = steps == ["NFC", "Replace", "Lowercase"] and splits == [RULE, None] and kind["model"].get("end_of_word_suffix") == SUFFIX
        if self.parts:
            merges = Tokenizer.from_str(json.dumps(kind | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}))
            self.merges, self.letters = merges, {b: c for b, c in byte_letters().items() if b != 32}
            self.last = np.zeros(1 + max(merges.get_vocab().values()), dtype=bool)
            self.last[[i for t, i in merges.get_vocab().items() if t.endswith(SUFFIX)]] = True
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.ids = np.empty(0, dtype="<u4")
        self.first = np.zeros(1, dtype=np.int64)  # of each word in ids, and the end

    def encode(self, words: list[bytes], whole: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in a row, and how many each has."""
        run = lambda t, x: [np.array(e.ids, dtype="<u4") for e in t.encode_batch_fast(x, add_special_tokens=False)]
        if whole:
            got = run(self.tokenizer, [w.decode() for w in words])
            return np.concatenate(got), np.fromiter(map(len, got), np.int64, len(got))
        lines = [b" ".join(words[i : i + self.LINE]).decode("latin-1").translate(self.letters) for i in range(0, len(words), self.LINE)]
        ids = np.concatenate(run(self.merges, lines))
        at = np.flatnonzero(self.last[ids])
        if len(at) != len(words):
            raise ValueError("the tokenizer joins words")
        return ids, np.diff(at, prepend=-1)

    def learn(self, words: list[bytes], whole: np.ndarray) -> None:
        for kind in (False, True):
            part = [words[i] for i in np.flatnonzero(whole == kind).tolist()]
            if part:
                ids, sizes = self.encode(part, kind)
                self.place.update(zip(part, range(len(self.place), len(self.place) + len(part)), strict=True))
                self.ids = np.concatenate([self.ids, ids])
                self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes)])

    def tokens(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, int]]:
        """Of each text its ids, with the end id, and how many of them are its prompt."""
        if len(self.place) > MEMO:
            self.clear()
        coded, codes, counts, prompts, whole = coded_words(texts, self.parts)
        words = coded.to_pylist()
        at = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            fresh = [words[i] for i in missing.tolist()]
            self.learn(fresh, whole[missing])
            at[missing] = [self.place[w] for w in fresh]
        first, n = self.first[at][codes], (self.first[at + 1] - self.first[at])[codes]
        ends = np.append(0, np.cumsum(n))
        flat = self.ids[np.repeat(first - ends[:-1], n) + np.arange(ends[-1])]
        stops = np.cumsum(counts)
        begins = ends[stops - counts]
        end = np.array([END], dtype="<u4")
        for a, b, p in zip(begins.tolist(), ends[stops].tolist(), (ends[stops - counts + prompts] - begins).tolist(), strict=True):
            yield np.concatenate([flat[a:b], end]), p

    def __call__(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """Ids of each text, with the end id."""
        return (ids for ids, _ in self.tokens(texts))


_ENCODERS: dict[str, WordIds] = {}


def encoder(path: str) -> WordIds:
    """One for each worker process; its memo outlives a task and is bounded by MEMO words and a batch."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordIds(path)
    return _ENCODERS[path]


class Packer:
    """Places (document, demand) pieces into sequences; yields placed pieces.

    A document comes as its key, ids and loss mask (or None: all tokens bear
    loss). Output: key, start, ids of the piece, length of the document,
    sequence number, offset in the sequence, loss-bearing tokens.
    """

    def __init__(self, tokens: int = TOKENS, segments: int = SEGMENTS, loss: int | None = None, pool: int = POOL, least: int = LEAST):
        self.limit = np.array([tokens, segments, tokens if loss is None else loss], dtype=np.float64)
        self.pool, self.least, self.sequence = pool, least, 0
        self.items: list[tuple] = []  # key, start, ids, mask, doc length

    @staticmethod
    def demand(item: tuple) -> tuple[int, int, int]:
        return len(item[2]), 1, len(item[2]) if item[3] is None else int(np.count_nonzero(item[3]))

    @staticmethod
    def lead(item: tuple) -> int:
        """Tokens before the first one that bears loss."""
        return 0 if item[3] is None else int(item[3].argmax()) if item[3].any() else len(item[2])

    def add(self, key, ids: np.ndarray, mask: np.ndarray | None = None) -> Iterator[tuple]:
        start, n, step = 0, len(ids), int(self.limit[[0, 2]].min())
        if mask is None and self.limit[2] >= self.limit[0]:
            while n - start >= step:  # fills a sequence alone
                yield key, start, ids[start : start + step], n, self._next(), 0, step
                start += step
        while start < n:
            stop = min(n, start + step)
            self.items.append((key, start, ids[start:stop], None if mask is None else mask[start:stop], n))
            start = stop
            if len(self.items) >= self.pool:
                yield from self._pack(self.pool // 4)

    def close(self) -> Iterator[tuple]:
        yield from self._pack(0)

    def _next(self) -> int:
        self.sequence += 1
        return self.sequence - 1

    @staticmethod
    def _cut(item: tuple, room: np.ndarray) -> int:
        """Tokens of the item that fit into the room."""
        if room[1] < 1:
            return 0
        n = min(len(item[2]), int(room[0]))
        if item[3] is None:
            return min(n, int(room[2]))
        return min(n, int(np.searchsorted(np.cumsum(item[3]), room[2], side="right")))

    def _pack(self, leave: int) -> Iterator[tuple]:
        """Fills sequences until `leave` pieces wait; at 0 the rest is cut at powers of two."""
        items = self.items
        if not items:
            return
        need = np.array([self.demand(i) for i in items], dtype=np.float64)
        lead = np.array([self.lead(i) for i in items])
        alive = np.ones(len(items), dtype=bool)
        weight = need.mean(axis=0) / self.limit / self.limit
        left = len(items)
        while left > leave:
            limit = self.limit
            if leave == 0:  # the last ones: full sequences while there is enough, then powers of two
                total = need[alive].sum(axis=0)
                if total[0] < limit[0]:
                    size = 1 << (int(total[0]).bit_length() - 1)
                    if size >= self.least:
                        limit = np.array([size, limit[1], min(size, limit[2])], dtype=np.float64)
            room, offset, number = limit.copy(), 0, self._next()
            while room[0] > 0 and left:
                able = alive & (need <= room).all(axis=1)
                whole = able.any()
                if not whole:  # those of which a part fits
                    able = alive if room[2] > 0 else alive & (lead > 0)
                    if room[1] < 1 or not able.any():
                        break
                score = need @ (weight * room) if whole or room[2] > 0 else lead
                best = int(np.where(able, score, -1.0).argmax())
                key, start, ids, mask, length = items[best]
                n = len(ids) if whole else self._cut(items[best], room)
                used = self.demand((key, start, ids[:n], None if mask is None else mask[:n], length))
                yield key, start, ids[:n], length, number, offset, used[2]
                room -= used
                offset += n
                if n < len(ids):
                    items[best] = (key, start + n, ids[n:], None if mask is None else mask[n:], length)
                    need[best], lead[best] = self.demand(items[best]), self.lead(items[best])
                else:
                    alive[best] = False
                    left -= 1
        self.items = [i for i, a in zip(items, alive, strict=True) if a]


def packed(batches: Iterable[pa.RecordBatch], path: str, part: int, whole: bool = False, **limits) -> Iterator[pa.RecordBatch]:
    """The placed pieces of rows (doc_id, text and, if a column says so, loss); with whole, their ids too."""
    encode, packer, rows = encoder(path), Packer(**limits), []
    base = part << 40

    def row(p: tuple) -> tuple:
        key, start, ids, length, number, offset, loss = p
        return key, start, len(ids), zlib.crc32(ids.tobytes()), length, base + number, offset, loss, *([ids.astype(np.int32)] if whole else [])

    def out(force: bool = False) -> Iterator[pa.RecordBatch]:
        if rows and (force or len(rows) > 20_000):
            cols = list(zip(*rows, strict=True))
            arrays = [pa.array(c, pa.int64()) for c in cols[: len(_NAMES)]] + [pa.array(c, pa.list_(pa.int32())) for c in cols[len(_NAMES) :]]
            yield pa.RecordBatch.from_arrays(arrays, names=[*_NAMES, *(["ids"] if whole else [])])
            rows.clear()

    for batch in chunks(iter(batches), limit=4_000_000):
        texts = [t or b"" for t in raw(batch.column("text"))]
        said = batch.column("loss").to_pylist() if "loss" in batch.schema.names else repeat(None)
        for key, bears, (ids, prompt) in zip(batch.column("doc_id").to_pylist(), said, encode.tokens(texts), strict=False):
            mask = np.ones(len(ids), np.uint8)
            mask[: prompt if bears is None else 0 if bears else len(ids)] = 0
            rows.extend(row(p) for p in packer.add(key, ids, mask))
        yield from out()
    rows.extend(row(p) for p in packer.close())
    yield from out(True)


def pack(docs: DataFrame, path: str, loss: int = LOSS, loss_column: str | None = None, with_ids: bool = False, **limits) -> DataFrame:
    """One row per placed piece of every document (with its ids, if wanted).

    `loss_column` is a boolean column of docs: whether a row's tokens bear loss
    (null: the prompt rule).
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from packed(batches, path, TaskContext.get().partitionId(), with_ids, loss=loss, **limits)

    narrow = columns(docs, "doc_id", "text")
    if loss_column is not None:
        narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col(f"`{loss_column}`").cast("boolean").alias("loss"))
    return narrow.mapInArrow(task, SCHEMA + ", ids array<int>" * with_ids)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())


def padding(pieces: DataFrame, tokens: int = TOKENS) -> DataFrame:
    """Sequences, tokens and padding of a packing."""
    fill = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    power = F.bit_count("n") == 1
    return fill.agg(
        F.count(F.lit(1)).alias("sequences"),
        F.sum("n").alias("tokens"),
        F.sum(F.when(power, F.lit(0)).otherwise(F.lit(tokens) - F.col("n"))).alias("padding"),
    )
