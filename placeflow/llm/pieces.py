"""Operator 6: SentencePiece encoding and decoding as a relational lattice.

Text is normalised as the piece model does (a dummy space in front, spaces as
U+2581) and cut into segments where no piece reaches across: between two bytes
that are neighbours in no piece. Distinct segments are counted over all
documents, and only they are encoded:

1. explode the substrings from each start, up to the longest piece that begins
   with the same characters,
2. equi-join them to the piece table (broadcast: its size is the vocabulary's),
3. group the edges by segment and stop,
4. fold Viterbi over the segment's stops with the higher-order `aggregate`.

The path with the largest sum of piece scores wins; ties go to the longer last
piece. A character without a piece of its own becomes its UTF-8 bytes, at a
cost below every score. This is the unigram rule on the pieces' scores: for a
model made by merging pairs it can differ from the order of merges, and it
always decodes to the same text. Pieces that the model never chooses (score
-1e9) are left out, and so are those that can't be on a best path, as other
pieces make the same characters with a larger sum (`_may_win`): no result
depends on them. Segments are cut by all pieces.

Long segments are folded in two levels, an inner fold over the stops of a block
and an outer one over blocks, so that a segment's time grows with its length,
also where a long text has no place to cut (measured: 32,000
characters 5.0 s, 64,000 7.3 s, 128,000 10.4 s, on four cores).
Its lattice is one row then, some 300 bytes a character: a row's limit of 2 GB
is met by a stretch of some seven million characters without any cut.

`encode` gives the ids of distinct segments, `encoded` the ids of documents in
order, `decode` turns ids back to text, and `documents` says of every document
how many segments and pieces it has, a digest of its ids, and whether they
decode to its text. A text that holds U+2581 itself decodes to a space there,
so it doesn't come back as it was.

Nulls: a null text, like an empty one, has no pieces. Repeated rows get the
same values. Empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeflow.llm.common import chunks, columns, commonest, discarded, raw, table, written

SPACE = "▁"
NEVER = -1e8
#: Segments whose encoding is broadcast to the tasks; rarer ones meet theirs in a join.
KNOWN = 400_000
#: Distinct segments that a task holds before it hands their counts on.
HELD = 300_000
#: Characters by which the pieces that can begin at a place are bounded.
HEAD = 4
#: Stops of a block of the fold.
FOLDED = 256
#: Characters of a block that is read at once, and of a segment whose lattice goes by a number.
BLOCK, LONG = 512, 64

_SPACE = SPACE.encode()


def coded_segments(texts: list[bytes], cuts: np.ndarray) -> tuple[pa.LargeBinaryArray, np.ndarray, np.ndarray]:
    """The distinct segments of the texts (a blank for U+2581), the code of each segment in a row, and how many each text has.

    A text's segments join to the normalised text; an empty text has none.
    """
    lines = [b" " + t.replace(_SPACE, b" ") if t else b"" for t in texts]
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    buf = np.frombuffer(b"".join(lines), np.uint8)
    if not len(buf):
        return pa.array([], pa.large_binary()), np.empty(0, np.int64), np.zeros(len(texts), np.int64)
    new = np.ones(len(buf), dtype=bool)
    new[1:] = cuts[buf[:-1].astype(np.uint16) << 8 | buf[1:]]
    first = np.cumsum(sizes) - sizes
    new[first[sizes > 0]] = True
    start = np.flatnonzero(new)
    ends = np.append(start, len(buf))
    coded = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(buf)]).dictionary_encode()
    upto = np.searchsorted(start, first + sizes)
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), np.diff(upto, prepend=0)


def _items(coded: pa.LargeBinaryArray) -> list[bytes]:
    """The array's values (no nulls), without an Arrow scalar for each."""
    ends = np.frombuffer(coded.buffers()[1], np.int64)[coded.offset : coded.offset + len(coded) + 1].tolist() if len(coded) else [0]
    data = (coded.buffers()[2] or b"")[ends[0] : ends[-1]]
    data = data if isinstance(data, bytes) else data.to_pybytes()
    return [data[a - ends[0] : b - ends[0]] for a, b in zip(ends, ends[1:], strict=False)]


def segments(text: bytes, known: dict) -> list[bytes]:
    """Segments of a text, in order."""
    coded, codes, _ = coded_segments([text], known["cuts"])
    return coded.take(pa.array(codes)).to_pylist()


def _may_win(scores: dict[str, float]) -> list[bool]:
    """Of each piece, whether no row of other pieces makes its characters with a larger sum.

    With such a row, a path through the piece is never best, ties included. Sums
    of a few 32-bit scores are exact here.
    """

    def others(piece: str) -> float:
        top = [0.0] + [-np.inf] * len(piece)
        for end in range(1, len(piece) + 1):
            first = 1 if end == len(piece) else 0  # not the piece itself
            top[end] = max((top[s] + scores.get(piece[s:end], -np.inf) for s in range(first, end)), default=-np.inf)
        return top[-1]

    return [others(p) <= score for p, score in scores.items()]


def piece_table(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    """piece (with a blank for U+2581), id and score of the ordinary pieces that can be on a best path; and what the lattice needs to know of the model."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    rows = [(sp.id_to_piece(i), i, float(sp.get_score(i))) for i in plain if sp.get_score(i) > NEVER]
    cuts = np.ones(1 << 16, dtype=bool)
    cuts.reshape(256, 256)[:, 0x80:0xC0] = False  # inside a character
    for p, _, _ in rows:
        b = np.frombuffer(p.replace(SPACE, " ").encode(), np.uint8)
        cuts[b[:-1].astype(np.uint16) << 8 | b[1:]] = False
    base = sp.piece_to_id("<0x00>")
    names = [b""] * max(base + 256, 1 + max((i for _, i, _ in rows), default=0))
    names[base : base + 256] = [bytes([i]) for i in range(256)]
    for p, i, _ in rows:
        names[i] = p.encode()
    known = {
        "longest": max(len(p) for p, _, _ in rows),
        "unknown": min(s for _, _, s in rows) - 10.0,
        "byte": base,
        "cuts": cuts,
        "texts": (np.frombuffer(b"".join(names), np.uint8), np.fromiter(map(len, names), np.int64, len(names))),  # of all ids in a row
    }
    rows = list(compress(rows, _may_win({p: s for p, _, s in rows})))
    frame = pa.table({"piece": [r[0].replace(SPACE, " ") for r in rows], "id": pa.array([r[1] for r in rows], pa.int32()), "score": [r[2] for r in rows]})
    return spark.createDataFrame(frame), known


def segment_counts(docs: DataFrame, known: dict) -> DataFrame:
    """segment and n over all texts."""
    cuts = known["cuts"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, held = [], 0

        def out() -> pa.RecordBatch:
            sums = pa.table({"segment": pa.chunked_array([s for s, _ in met]).combine_chunks(), "n": np.concatenate([n for _, n in met])}).group_by("segment").aggregate([("n", "sum")]).combine_chunks()
            met.clear()
            return pa.RecordBatch.from_arrays([sums.column("segment").cast(pa.large_string()).cast(pa.string()).combine_chunks(), sums.column("n_sum").combine_chunks()], names=["segment", "n"])

        for batch in chunks(batches, limit=2_000_000):
            coded, codes, _ = coded_segments([t or b"" for t in raw(batch.column("text"))], cuts)
            if len(coded):
                met.append((coded, np.bincount(codes, minlength=len(coded))))
                held += len(coded)
            if held > HELD:
                yield out()
                held = 0
        if met:
            yield out()

    return docs.select("text").mapInArrow(task, "segment string, n bigint").groupBy("segment").agg(F.sum("n").alias("n"))


def _by_blocks(items: Column, start: Column, step, finish) -> Column:
    """A fold over a long list, FOLDED items at a time: step(state, block) makes the next state, so nothing is carried through the single items."""
    at = F.sequence(F.lit(0), F.greatest(F.size(items) - 1, F.lit(0)), F.lit(FOLDED))
    return F.aggregate(at, start, lambda state, b: step(state, F.slice(items, b + 1, F.lit(FOLDED))), finish)


def _stops(words: DataFrame, pieces: DataFrame, known: dict, key: list[str], blocks: bool) -> DataFrame:
    """key and stops: for each stop of a segment, in order, the edges that end there. key names the rows of words.

    Long segments are read in blocks, since a place in a string is found by walking to it.
    """
    longest, size = known["longest"], F.length("segment")
    if not blocks:
        starts = words.select(*key, *({"segment"} - set(key)), F.explode(F.sequence(F.lit(0), size - 1)).alias("_s"))
        # few characters begin a long piece
        heads = pieces.filter(F.length("piece") >= HEAD).groupBy(F.substring("piece", 1, HEAD).alias("_head")).agg(F.max(F.length("piece")).alias("_reach"))
        starts = starts.join(F.broadcast(heads), F.substring("segment", F.col("_s") + 1, F.lit(HEAD)) == F.col("_head"), "left")
        spans = starts.withColumn("_n", F.explode(F.sequence(F.lit(1), F.least(F.coalesce("_reach", F.lit(HEAD - 1)), size - F.col("_s")))))
        cut = spans.select(*key, "_s", "_n", F.substring("segment", F.col("_s") + 1, F.col("_n")).alias("piece"))
    else:
        own = words.select(*key, "segment", F.explode(F.sequence(F.lit(0), size - 1, F.lit(BLOCK))).alias("_b"))
        parts = own.select(*key, "_b", F.substring("segment", F.col("_b") + 1, F.lit(BLOCK + longest - 1)).alias("_part"), F.least(F.lit(BLOCK), size - F.col("_b")).alias("_size"))
        starts = parts.select(*key, "_b", "_part", F.explode(F.sequence(F.lit(0), F.col("_size") - 1)).alias("_s"))
        views = starts.select(*key, (F.col("_b") + F.col("_s")).alias("_s"), F.substring("_part", F.col("_s") + 1, F.lit(longest)).alias("_view"))
        spans = views.select(*key, "_s", "_view", F.explode(F.sequence(F.lit(1), F.length("_view"))).alias("_n"))
        cut = spans.select(*key, "_s", "_n", F.substring("_view", F.lit(1), F.col("_n")).alias("piece"))
    table_ = F.broadcast(pieces.select("piece", "id", "score"))  # the vocabulary
    edges = cut.join(table_, "piece", "left").filter("id IS NOT NULL OR _n = 1")
    # a character without a piece goes by its UTF-8 bytes, as a number under -1
    char = F.translate("piece", " ", SPACE)
    unknown = -1 - F.conv(F.hex(F.encode(char, "UTF-8")), 16, 10).cast("bigint")
    edge = F.struct(F.coalesce("score", F.lit(known["unknown"])).alias("score"), F.col("_n").alias("n"), F.coalesce(F.col("id").cast("bigint"), unknown).alias("id"))
    if not blocks:  # one grouping is cheaper than two, and few edges are soon looked through for each stop
        flat = F.struct((F.col("_s") + F.col("_n")).alias("stop"), edge["score"].alias("score"), edge["n"].alias("n"), edge["id"].alias("id"))
        ending = lambda s: F.struct(F.filter("_e", lambda e: e["stop"] == s).alias("edges"))
        return edges.groupBy(*key).agg(F.collect_list(flat).alias("_e")).select(*key, F.transform(F.sequence(F.lit(1), size), ending).alias("stops"))
    stops = edges.groupBy(*key, (F.col("_s") + F.col("_n")).alias("stop")).agg(F.collect_list(edge).alias("edges"))
    return stops.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("stop", "edges"))).alias("stops"))


def encode(words: DataFrame, pieces: DataFrame, known: dict, *carried: str) -> DataFrame:
    """segment, the carried columns and ids (the best path's piece ids) of words, whose segments are distinct.

    The rows of a long segment's lattice go by a number instead of the segment.
    Both filters read words, so they should be kept. Short ones go to small
    partitions (each will have a lattice).
    """
    parts = 16 * int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    short = words.select("segment", *carried).filter(F.length("segment") <= LONG).repartition(parts, "segment")
    folded = _folded(_stops(short, pieces, known, ["segment", *carried], False), known, False, "segment", *carried)
    long = written(words.select("segment", *carried).filter(F.length("segment") > LONG).withColumn("_id", F.monotonically_increasing_id()))
    if long.isEmpty():
        return folded
    met = long.join(_folded(_stops(long, pieces, known, ["_id"], True), known, True, "_id"), "_id")
    return folded.unionByName(met.select("segment", *carried, "ids"))


def _path(lattice: DataFrame, *key: str) -> DataFrame:
    """key and _t: the best path through the stops of short segments.

    The way there keeps only the best sum of each stop; the way back finds the
    edges that made it, at the few stops on the path.
    """
    size, here = F.size("stops"), lambda s: F.element_at("_sums", s + 1)

    def step(sums, stop):
        return F.array_append(sums, F.array_max(F.transform(stop["edges"], lambda e: F.element_at(sums, -e["n"]) + e["score"])))

    def back(taken, s):
        """From the end: at a stop where the piece taken before starts, takes the longest of the best."""
        best = F.filter(F.element_at("stops", s)["edges"], lambda e: here(s - e["n"]) + e["score"] == here(s))
        way = F.array_min(F.transform(best, lambda e: F.struct((s - e["n"]).alias("start"), e["id"].alias("id"))))
        return F.when(F.element_at(taken, -1)["start"] != s, taken).otherwise(F.array_append(taken, way))

    summed = lattice.select(*key, "stops", F.aggregate("stops", F.array(F.lit(0.0)), step).alias("_sums"))
    end = F.array(F.struct(size.alias("start"), F.lit(0).cast("bigint").alias("id")))
    found = F.aggregate(F.sequence(size, F.lit(1), F.lit(-1)), end, back, lambda taken: F.slice(F.reverse(taken["id"]), F.lit(1), F.size(taken) - 1))
    return summed.select(*key, found.alias("_t"))


def _folded(lattice: DataFrame, known: dict, blocks: bool, *key: str) -> DataFrame:
    """key and ids: the best path through the stops.

    With blocks, an inner fold goes over a block's stops and an outer one over
    the blocks. The inner one starts from the last nodes before its block and
    holds no others, so each node is copied as often as in any other block.
    """
    longest, base = known["longest"], known["byte"]
    node = "struct<score: double, n: int, id: bigint>"
    first = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("n"), F.lit(0).cast("bigint").alias("id"))).cast(f"array<{node}>")
    none = F.array().cast("array<bigint>")

    def step(nodes, stop):
        """The best way to the next stop: the largest sum, then the longest last piece."""
        ways = F.transform(stop["edges"], lambda e: F.struct((F.element_at(nodes, -e["n"])["score"] + e["score"]).alias("score"), e["n"].alias("n"), e["id"].alias("id")))
        return F.concat(nodes, F.array(F.array_max(ways)))

    def back(state, best):
        """From the end: takes the piece that stops where the one taken before starts."""
        skipped = F.struct((state["skip"] - 1).alias("skip"), state["taken"].alias("taken"))
        return F.when(state["skip"] > 0, skipped).otherwise(F.struct((best["n"] - 1).alias("skip"), F.concat(state["taken"], F.array(best["id"])).alias("taken")))

    def taking(skip):
        return F.struct(skip.alias("skip"), none.alias("taken"))

    def block(done, stops):
        """The blocks done and the nodes of the next one."""
        tail = F.element_at(done, -1)
        tail = F.slice(tail, F.greatest(F.size(tail) - (longest - 1), F.lit(1)), F.lit(longest))
        return F.aggregate(stops, tail, step, lambda nodes: F.concat(done, F.array(F.slice(nodes, F.size(tail) + 1, F.lit(FOLDED)))))

    def block_back(done, nodes):
        return F.aggregate(nodes, taking(done["skip"]), back, lambda s: F.struct(s["skip"].alias("skip"), F.concat(done["blocks"], F.array(s["taken"])).alias("blocks")))

    if blocks:
        best = _by_blocks(F.col("stops"), F.array(first), block, F.flatten)
        solved = lattice.select(*key, best.alias("best")).select(*key, F.reverse(F.slice("best", F.lit(2), F.size("best"))).alias("best"))
        begin = F.struct(F.lit(0).alias("skip"), F.array().cast("array<array<bigint>>").alias("blocks"))
        found = solved.select(*key, _by_blocks(F.col("best"), begin, block_back, lambda s: F.reverse(F.flatten(s["blocks"]))).alias("_t"))
    else:
        found = _path(lattice, *key)

    def spelled(i):
        code = F.hex(-1 - i)
        code = F.lpad(code, (F.length(code) + F.length(code) % 2).cast("int"), "0")
        bytes_ = F.transform(F.sequence(F.lit(0), (F.length(code) / 2 - 1).cast("int")), lambda k: (F.lit(base) + F.conv(F.substring(code, (2 * k + 1).cast("int"), F.lit(2)), 16, 10).cast("int")).cast("int"))
        return F.when(i >= 0, F.array(i.cast("int"))).otherwise(bytes_)

    return found.select(*key, F.when(F.array_min("_t") >= 0, F.col("_t").cast("array<int>")).otherwise(F.flatten(F.transform("_t", spelled))).alias("ids"))


def _ragged(flat: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The stretches of flat (of these sizes, in a row) that at names, in a row."""
    first, n = (np.cumsum(sizes) - sizes)[at], sizes[at]
    ends = np.cumsum(n)
    return flat[np.repeat(first - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's segments and their ids as one compressed blob: count, sizes, id counts, bytes, ids."""
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        own = batch.column("_own")
        ends = np.append(0, np.cumsum(own.value_lengths().to_numpy(zero_copy_only=False))).astype(np.int64)
        items = own.flatten()
        names, ids = items.field("segment"), items.field("ids")
        at = np.frombuffer(names.buffers()[1], np.int32)[names.offset : names.offset + len(names) + 1]
        data, flat = memoryview(names.buffers()[2] or b""), ids.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        sizes, counts = np.diff(at).astype("<u4"), ids.value_lengths().to_numpy(zero_copy_only=False).astype("<u4")
        upto = np.append(0, np.cumsum(counts, dtype=np.int64))
        blobs = []
        for a, b in zip(ends.tolist(), ends[1:].tolist(), strict=False):
            head = np.array([b - a], "<u4").tobytes() + sizes[a:b].tobytes() + counts[a:b].tobytes()
            blobs.append(press.compress(head + bytes(data[at[a] : at[b]]) + flat[upto[a] : upto[b]].tobytes()))
        yield pa.RecordBatch.from_arrays([batch.column("_k"), pa.array(blobs, pa.binary())], names=["_k", "_own"])


def _unpacked(blob: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Segments, their ids in a row, and how many each has."""
    blob = zstandard.ZstdDecompressor().decompress(blob)
    n = int.from_bytes(blob[:4], "little")
    sizes, counts = np.frombuffer(blob, "<u4", 2 * n, 4).reshape(2, n).astype(np.int64)
    ends = 4 + 8 * n + np.append(0, np.cumsum(sizes))
    return [blob[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist(), strict=False)], np.frombuffer(blob[ends[-1] :], "<u4").astype(np.int64), counts


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a key of both, under which a row's rare segments travel."""
    return columns(docs, "doc_id", "text").withColumn("_key", F.struct(F.col("doc_id"), F.xxhash64("text").alias("h")))


def segment_ids(docs: DataFrame, pieces: DataFrame, known: dict) -> DataFrame:
    """segment, n and ids of all distinct segments.

    Texts are counted once. Lattices are grouped in memory: a partition holds few segments (`encode`).
    """
    spark, key = docs.sparkSession, "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, str(1 << 20))
    try:
        counts = written(segment_counts(docs, known))
        out = written(encode(counts, pieces, known, "n"))
    finally:
        spark.conf.set(key, before)
    discarded(counts)
    return out


def _finished(batch: pa.RecordBatch) -> pa.RecordBatch:
    return batch.select(["doc_id", "ids", "n_segments"])


def encoded(docs: DataFrame, words: DataFrame, known: dict, finish: Callable = _finished, kind: str = "doc_id bigint, ids array<int>, n_segments bigint") -> DataFrame:
    """doc_id, ids and n_segments of every document, from the ids of all segments.

    `finish` makes the result's rows of batches that have the text (compressed; null if null), too.
    """
    spark, cuts = docs.sparkSession, known["cuts"]
    top = commonest(words, "segment", KNOWN).toArrow()
    flat = top.column("ids").combine_chunks()
    shared = spark.sparkContext.broadcast((raw(top.column("segment")), flat.flatten().to_numpy(), flat.value_lengths().to_numpy().astype(np.int64)))

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each distinct segment of a text that isn't listed."""
        listed = set(shared.value[0])
        for batch in chunks(batches, limit=2_000_000):
            coded, codes, counts = coded_segments([t or b"" for t in raw(batch.column("text"))], cuts)
            names = _items(coded)
            strange = np.fromiter((w not in listed for w in names), bool, len(names))
            pairs = np.unique(np.repeat(np.arange(len(counts)), counts)[strange[codes]] * max(1, len(names)) + codes[strange[codes]])
            doc, word = np.divmod(pairs, max(1, len(names)))
            tails = coded.take(pa.array(word)).cast(pa.large_string()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("_key").take(pa.array(doc)), tails], names=["_key", "segment"])

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, flat, sizes = shared.value
        places = dict(zip(listed, range(len(listed)), strict=True))
        grow = zstandard.ZstdDecompressor()
        for batch in chunks(batches, "blob", limit=400_000):
            texts = [grow.decompress(b) if b is not None else b"" for b in batch.column("blob").to_pylist()]
            own = batch.column("_own")
            coded, codes, counts = coded_segments(texts, cuts)
            names = _items(coded)
            # the rows' own segments follow the listed ones
            extra = [_unpacked(x) for x in own.to_pylist() if x is not None]
            here = {w: len(listed) + j for j, w in enumerate(chain.from_iterable(words_ for words_, _, _ in extra))}
            at = np.fromiter(map(places.get, names, repeat(-1)), np.int64, len(names))
            lost = np.flatnonzero(at < 0)
            at[lost] = [here[names[j]] for j in lost.tolist()]
            whole = np.concatenate([flat, *(ids for _, ids, _ in extra)])
            lengths = np.concatenate([sizes, *(counts_ for _, _, counts_ in extra)])
            out = _ragged(whole, lengths, at[codes]).astype(np.int32)
            ends = np.append(0, np.cumsum(lengths[at[codes]]))[np.append(0, np.cumsum(counts))]
            yield finish(pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(out)), pa.array(counts, pa.int64()), batch.column("blob")],
                names=["doc_id", "ids", "n_segments", "blob"],
            ))

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in chunks(batches):
            blobs = [None if t is None else press.compress(t) for t in raw(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(blobs, pa.binary())], names=["_key", "blob"])

    keyed = _keyed(docs)
    key = "_key struct<doc_id: bigint, h: bigint>"
    lone = keyed.select("_key", "text").mapInArrow(rare, f"{key}, segment string").join(words.select("segment", "ids"), "segment")
    sets = lone.groupBy("_key").agg(F.collect_set(F.struct("segment", "ids")).alias("_own"))  # distinct segments of one text
    own = written(sets.withColumnRenamed("_key", "_k").mapInArrow(_packed, key.replace("_key", "_k") + ", _own binary"))
    texts = keyed.select("_key", "text").mapInArrow(squeeze, f"{key}, blob binary")
    met = texts.join(own, F.col("_key").eqNullSafe(F.col("_k")), "left")
    whole = met.select(F.col("_key.doc_id").alias("doc_id"), "blob", "_own")
    return whole.mapInArrow(put, kind)


def decoded(ids: pa.ListArray, known: dict) -> list[bytes]:
    """The texts of rows of ids: pieces and bytes in a row, U+2581 as a space, without the dummy space in front."""
    flat, sizes = known["texts"]
    at = ids.flatten()
    names = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(np.append(0, np.cumsum(sizes))), pa.py_buffer(flat)])
    taken = names.take(at)  # its values lie in a row
    ends = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1] if len(taken) else np.zeros(1, np.int64)
    whole = (taken.buffers()[2] or pa.py_buffer(b"")).to_pybytes() if len(taken) else b""
    stops = ends[np.append(0, np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False)))].tolist()
    return [whole[a:b].replace(_SPACE, b" ")[1:] for a, b in zip(stops, stops[1:], strict=False)]


def decode(coded: DataFrame, known: dict) -> DataFrame:
    """doc_id and text of coded (doc_id, ids)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(decoded(batch.column("ids"), known), pa.binary()).cast(pa.string())], names=["doc_id", "text"])

    return coded.select("doc_id", "ids").mapInArrow(task, "doc_id bigint, text string")


def documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_segments, n_pieces, ids_digest and round_trip of every document, from its ids and what they decode to."""
    pieces, known = piece_table(docs.sparkSession, path)
    words = segment_ids(columns(docs, "doc_id", "text"), pieces, known)

    def told(batch: pa.RecordBatch) -> pa.RecordBatch:
        grow, ids = zstandard.ZstdDecompressor(), batch.column("ids")
        n = ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        flat, ends = ids.flatten().to_numpy(zero_copy_only=False).astype("<i4"), np.append(0, np.cumsum(n)).tolist()
        digests = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends, ends[1:], strict=False)]
        same = [t == (grow.decompress(b) if b is not None else b"") for t, b in zip(decoded(ids, known), batch.column("blob").to_pylist(), strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_segments"), pa.array(n), pa.array(digests, pa.int64()), pa.array(same, pa.bool_())], names=["doc_id", "n_segments", "n_pieces", "ids_digest", "round_trip"])

    out = encoded(docs, words, known, told, "doc_id bigint, n_segments bigint, n_pieces bigint, ids_digest bigint, round_trip boolean")
    discarded(words)  # the listed ones are broadcast, the others are with their rows
    return out


def op6_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
