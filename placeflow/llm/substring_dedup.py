"""Operator 10: long repeated spans by de Bruijn compaction.

The edges of the graph are the k-mers (windows of `K` words, nodes are their
two (K-1)-mers). A window is removed if it also starts in a document with a
smaller id.

1. Each task hashes the windows of its documents in blocks. Windows that a
   smaller document of the same block holds are settled on the spot, which
   leaves one copy per block of even the commonest window. The rest travels in
   packed columns to the bucket of its hash: 80 bits of hash, document, start.
2. A bucket finds the owner of each edge, a smaller document that holds it, with
   the owner's position. Buckets are cut by the windows' own hashes, so a common
   phrase with many different surroundings is spread over all of them, and a
   bucket keeps only its smallest document's copies of a window in memory,
   however many blocks hold it.
3. Settled edges of one document, owner and diagonal (the difference of the two
   source coordinates) compact: where as many begin as end, the path doesn't
   branch and the junction goes. What remains are the paths' heads and tails,
   which are ranked along the document and joined to one another.
4. The spans are verified at their source coordinates: the owners' words are
   fetched and digested there, the digest joins back to the span, and a
   document's words are removed only where their own digest is the same.

Nulls: a null text has no words. A null doc_id is not smaller than any id and
loses nothing. Rows with one doc_id are one document: none of them owns a
window of the others, and repeated rows get the same result. Documents of fewer
than K words lose nothing. Of several smaller documents with one window the
owner is any; the words removed are the same. A very long text is one block by
itself, held with some fifty bytes for each of its words. An empty table gives
no rows; extra columns are ignored by `spans` and kept by `strip`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeflow.llm.common import chunks, columns, discarded, raw, table, written
from placeflow.llm.tokens import mix, runs, starts_of, word_hashes

K = 13
#: Text bytes of a block, within which copies are settled before the shuffle.
BLOCK = 2_500_000
#: Windows that a bucket gathers, at least, before it settles them.
GATHERED = 400_000

PIECES = "bucket int, blob binary, doc bigint, start int, stop int, owner bigint, owner_start int"
_OUT = pa.schema([("bucket", pa.int32()), ("blob", pa.binary()), ("doc", pa.int64()), ("start", pa.int32()), ("stop", pa.int32()), ("owner", pa.int64()), ("owner_start", pa.int32())])
#: A travelling window: hash, more of it, document, start.
_RECORD = (np.dtype("<u8"), np.dtype("<u2"), np.dtype("<i8"), np.dtype("<u4"))


def _batch(rows: int, **cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(rows, f.type) for f in _OUT], schema=_OUT)


def _pieces(doc, start, owner, owner_start) -> pa.RecordBatch:
    """Settled windows as maximal pieces with one owner and one diagonal."""
    o = np.lexsort((start, doc))
    doc, start, owner, owner_start = (x[o] for x in (doc, start, owner, owner_start))
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1) | (owner[1:] != owner[:-1]) | (owner_start[1:] != owner_start[:-1] + 1)
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(doc)))
    return _batch(len(at), bucket=doc[at].astype(np.int64) & 0x7FFFFFFF, doc=doc[at], start=start[at], stop=start[at] + n, owner=owner[at], owner_start=owner_start[at])


def settled(wide: np.ndarray, more: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the windows that a smaller document holds too, of their owners' windows, and of the others in the order of their hashes."""
    order = np.argsort(wide)
    same = wide[order[1:]] == wide[order[:-1]]
    many = np.append(same, False) | np.append(False, same)
    some = order[many]
    some = some[np.lexsort((start[some], doc[some], more[some], wide[some]))]
    first = np.ones(len(some), dtype=bool)
    first[1:] = (wide[some[1:]] != wide[some[:-1]]) | (more[some[1:]] != more[some[:-1]])
    heads = np.flatnonzero(first)
    lead = some[np.repeat(heads, np.diff(np.append(heads, len(some))))]
    gone = doc[some] > doc[lead]
    order[np.flatnonzero(many)] = np.where(gone, -1, some)  # hashes are in the same order as before
    return some[gone], lead[gone], order[order >= 0]


def _packed(columns_: list[np.ndarray]) -> bytes:
    """Columns byte by byte of their numbers, which compresses sorted hashes and like ids."""
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(len(c), -1).T).tobytes() for c in columns_]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpacked(blob: bytes) -> list[np.ndarray]:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    n, at, out = len(flat) // sum(k.itemsize for k in _RECORD), 0, []
    for kind in _RECORD:
        size = n * kind.itemsize
        out.append(np.ascontiguousarray(flat[at : at + size].reshape(kind.itemsize, n).T).view(kind).reshape(-1))
        at += size
    return out


def edges(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Settled pieces (no blob), and packed windows for the buckets."""
    for batch in chunks(batches, limit=BLOCK):
        keys = batch.column("doc_id")
        texts = [t if t and k is not None else b"" for t, k in zip(raw(batch.column("text")), keys.to_pylist(), strict=True)]
        h, counts = word_hashes(texts)
        at, own = starts_of(counts, K)
        if not len(at):
            continue
        wide = runs(h, K)[at]
        more = runs(mix(h), K)[at].astype("<u2")
        doc, start = keys.fill_null(0).to_numpy()[own], (at - (np.cumsum(counts) - counts)[own]).astype(np.int64)
        gone, owner, left = settled(wide, more, doc, start)
        if len(gone):
            yield _pieces(doc[gone], start[gone], doc[owner], start[owner])
        bucket = ((wide[left] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        cols = [x[left].astype(k) for x, k in zip((wide, more, doc, start), _RECORD, strict=True)]
        blobs = [_packed([c[a:b] for c in cols]) for a, b in zip(cut, np.append(cut[1:], len(left)), strict=True)]
        yield _batch(len(cut), bucket=bucket[cut].astype(np.int32), blob=blobs)


def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of the buckets' windows, and those settled before; rows come sorted by bucket, pieces anywhere.

    A bucket keeps the smallest document's copies of each of its windows, and
    those that wait until there are as many.
    """
    kept, parts, waiting, now = None, [], 0, None

    def done() -> Iterator[pa.RecordBatch]:
        nonlocal kept, parts, waiting
        cols = [np.concatenate(c) for c in zip(*parts, *([kept] if kept else []), strict=True)]
        wide, more, doc, start = (c.astype(np.int64) if k.itemsize == 4 else c for c, k in zip(cols, _RECORD, strict=True))
        gone, owner, left = settled(wide, more, doc, start)
        if len(gone):
            yield _pieces(doc[gone], start[gone], doc[owner], start[owner])
        kept, parts, waiting = [c[left] for c in cols], [], 0

    for batch in batches:
        yield batch.filter(pc.is_null(batch.column("blob")))
        batch = batch.filter(pc.is_valid(batch.column("blob")))
        for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob").to_pylist(), strict=True):
            if parts and (bucket != now or waiting > max(GATHERED, len(kept[0]) if kept else 0)):
                yield from done()
            if bucket != now:
                kept, now = None, bucket
            parts.append(_unpacked(blob))
            waiting += len(parts[-1][0])
    if parts:
        yield from done()


def pieces_of(docs: DataFrame) -> DataFrame:
    """doc, start and stop (of windows), owner and owner_start: stretches of repeated windows."""
    n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    buckets = 8 * n
    packed = columns(docs, "doc_id", "text").mapInArrow(lambda b: edges(b, buckets), PIECES)
    found = packed.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(settle, PIECES)
    return written(found.select("doc", "start", "stop", "owner", "owner_start"))


PATH = ["doc", "owner", "diagonal"]


def junctions(pieces: DataFrame) -> DataFrame:
    """The open ends of the pieces along each path: place and side (1: head, -1: tail).

    Begins less ends are summed at each place; those of inner junctions cancel.
    """
    ends = F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("v")), F.struct(F.col("stop").alias("at"), F.lit(-1).alias("v"))))
    steps = pieces.select("doc", "owner", (F.col("start") - F.col("owner_start")).alias("diagonal"), ends.alias("e")).select(*PATH, "e.at", "e.v")
    open_ = steps.groupBy(*PATH, "at").agg(F.sum("v").alias("v")).filter("v <> 0")
    return open_.select(*PATH, "at", F.signum("v").cast("int").alias("side"), F.explode(F.sequence(F.lit(1), F.abs("v")))).drop("col")


def compact(open_: DataFrame) -> DataFrame:
    """Spans between heads and tails: doc, start and stop (of words), owner, owner_start.

    The n-th head of a path joins its n-th tail; where pieces of repeated rows
    overlap, the spans still cover the same words.
    """
    ranked = open_.withColumn("rank", F.row_number().over(Window.partitionBy(*PATH, "side").orderBy("at")))  # at most as many as a document has words
    heads, tails = (ranked.filter(F.col("side") == s).select(*PATH, "rank", F.col("at").alias(n)) for s, n in ((1, "start"), (-1, "_tail")))
    met = heads.join(tails, [*PATH, "rank"])
    return met.select("doc", "start", (F.col("_tail") + F.lit(K - 1)).alias("stop"), "owner", (F.col("start") - F.col("diagonal")).alias("owner_start"))


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def squeezed(docs: DataFrame, *carried: str) -> DataFrame:
    """docs with the texts compressed (blob in place of text), to travel."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in chunks(batches):
            blobs = [None if t is None else squeeze.compress(t) for t in raw(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carried], pa.array(blobs, pa.binary())], names=[*carried, "blob"])

    own = docs.select(*carried, "text")
    kinds = T.StructType([*[own.schema[c] for c in carried], T.StructField("blob", T.BinaryType())])
    return own.mapInArrow(task, kinds)


def verified(spans: DataFrame, docs: DataFrame) -> DataFrame:
    """The spans with the digest of their owner's words at the owner's coordinates (several, if rows of the owner differ there)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grow = zstandard.ZstdDecompressor()
        for batch in chunks(batches, "blob", limit=2_000_000):
            rows = []
            for owner, blob, wanted in zip(*(batch.column(c).to_pylist() for c in ("owner", "blob", "wanted")), strict=True):
                words = grow.decompress(blob).split()
                rows += [(owner, w["owner_start"], w["n"], _digest(words[w["owner_start"] : w["owner_start"] + w["n"]])) for w in wanted if w["owner_start"] + w["n"] <= len(words)]
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
            cols = zip(*rows, strict=True) if rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["owner", "owner_start", "n", "digest"])

    key = ["owner", "owner_start", "n"]
    sized = spans.withColumn("n", F.col("stop") - F.col("start"))
    wanted = sized.groupBy(*key).agg(F.count(F.lit(1))).groupBy("owner").agg(F.collect_list(F.struct("owner_start", "n")).alias("wanted"))  # different stretches of one text
    texts = squeezed(columns(docs, "doc_id", "text").filter("doc_id IS NOT NULL AND text IS NOT NULL").withColumnRenamed("doc_id", "owner"), "owner")
    told = texts.join(wanted, "owner").mapInArrow(task, "owner bigint, owner_start int, n int, digest binary").distinct()
    return sized.join(told, key).drop("n")


def spans(docs: DataFrame) -> DataFrame:
    """doc and spans of each document with repeated words: an array of start and stop in words, owner, owner_start and digest."""
    pieces = pieces_of(docs)
    open_ = written(junctions(pieces))
    discarded(pieces)
    found = written(compact(open_))
    discarded(open_)
    cover = F.sort_array(F.collect_list(F.struct("start", "stop", "owner", "owner_start", "digest")))  # at most as many as the document has words, for each owner
    out = written(verified(found, docs).groupBy("doc").agg(cover.alias("spans")))
    discarded(found)
    return out


def _stripped(batches: Iterator[pa.RecordBatch], texts: bool) -> Iterator[pa.RecordBatch]:
    grow = zstandard.ZstdDecompressor()
    for batch in chunks(batches, "blob"):
        counts, removed, out = [], [], []
        for blob, cover in zip(batch.column("blob").to_pylist(), batch.column("_cover"), strict=True):
            t = None if blob is None else grow.decompress(blob)
            ws = (t or b"").split()
            gone = np.zeros(len(ws), dtype=bool)
            for s in cover.as_py() or ():
                if s["stop"] <= len(ws) and not gone[s["start"] : s["stop"]].all() and _digest(ws[s["start"] : s["stop"]]) == s["digest"]:
                    gone[s["start"] : s["stop"]] = True
            counts.append(len(ws))
            removed.append(int(gone.sum()))
            kept = [w for w, g in zip(ws, gone.tolist(), strict=True) if not g] if removed[-1] else ws
            if texts:
                out.append(t if not removed[-1] else b" ".join(kept))
            else:
                out.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        cols = {"n_words": pa.array(counts, pa.int64()), "n_removed": pa.array(removed, pa.int64())}
        cols |= {"kept_text": pa.array(out, pa.binary()).cast(pa.string())} if texts else {"kept_sha256": pa.array(out, pa.string())}
        rest = [n for n in batch.schema.names if n not in ("_cover", "blob")]
        yield pa.RecordBatch.from_arrays([batch.column(n) for n in rest] + list(cols.values()), names=[*rest, *cols])


def _joined(docs: DataFrame, *carried: str) -> DataFrame:
    """docs (columns text, _doc and those carried) with their compressed texts (blob) and _cover, the removed spans."""
    cover = spans(docs.select(F.col("_doc").alias("doc_id"), "text")).select(F.col("doc").alias("_d"), F.transform("spans", lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"), x["digest"].alias("digest"))).alias("_cover"))
    packed = squeezed(docs, "_doc", *carried)
    return packed.join(cover, F.col("_doc") == F.col("_d"), "left").select("_doc", *carried, "blob", "_cover")


def strip(docs: DataFrame) -> DataFrame:
    """docs with repeated spans removed from the texts (kept words joined by one space; others as they were)."""
    rest = [c for c in docs.columns if c != "text"]
    own = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in rest]).alias("_row"), *[F.col(f"`{n}`").alias(m) for n, m in (("text", "text"), ("doc_id", "_doc"))])
    kinds = T.StructType([T.StructField("_doc", T.LongType()), T.StructField("_row", own.schema["_row"].dataType), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])
    out = _joined(own, "_row").mapInArrow(lambda b: _stripped(b, True), kinds)
    fresh = {"text": F.col("kept_text")}
    if "n_chars" in rest:
        fresh["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("bigint")).otherwise(F.col("_row.n_chars"))
    return out.select(*[(fresh[c] if c in fresh else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row."""
    own = columns(docs, "doc_id", "text").select(F.col("doc_id").alias("_doc"), "text")
    return _joined(own).mapInArrow(lambda b: _stripped(b, False), "_doc bigint, n_words bigint, n_removed bigint, kept_sha256 string").withColumnRenamed("_doc", "doc_id")


def op10_debruijn_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
