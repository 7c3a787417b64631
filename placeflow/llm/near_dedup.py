"""Operator 9: near-duplicate documents by HyperMinHash.

Each document's set of word shingles is hashed once. The top bits of a hash
choose one of `REGISTERS` buckets and the bucket's least hash is stored
compressed, as its count of leading zeros and `MANTISSA` bits after them.
An empty bucket borrows from the first filled one in a fixed random order, so
short documents have full sketches too. `BANDS` bands of `ROWS` registers are
the blocking keys: at similarity 0.8 a pair shares none of them with a
probability near 1e-5.

1. Documents with equal sets form a class, a single row seen through its
   smallest doc_id.
2. In each band bucket the classes meet one of them, the pivot: a star, not all
   pairs. It is the one that shares most buckets with others. Sizes and then the
   sketches' Jaccard estimate, corrected for chance collisions of compressed
   registers, discard hopeless pairs.
3. The rest is confirmed on the full sets, and confirmed links are contracted
   to components by large-star and small-star steps.
4. Members of buckets that still hold several components are blocked anew, by
   their rarest shingles: two sets that are similar enough share one of them,
   whatever their sizes (a prefix filter). In these blocks members meet two
   pivots, then more, and at last all members of other components; no pair is
   tried twice. So a large group of copies costs a few comparisons for each of
   its members, unlike texts around a common passage or of common words don't
   meet, and no bucket is left unfinished.

A document with fewer words than a shingle has its whole sequence as its only
shingle; without words (or with a null text) its set is empty and it is linked
with nothing. Rows with one doc_id are one document. A row without doc_id is
linked with nothing, its component is null and it is kept. Repeated rows get
the same result and cost no comparison; a doc_id with several texts is linked
wherever one of them is. Ties between pivots go to the smaller doc_id. A very
long text is one row of a batch, whose shingle hashes (8 bytes a word, a few
times over) are held at once. Empty tables give no rows; extra columns are ignored by
`link` and kept by `keep`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeflow.llm.common import checkpointed, chunks, columns, raw, table
from placeflow.llm.tokens import mix, runs, word_hashes

REGISTERS, MANTISSA, BANDS, ROWS = 256, 10, 48, 6
SIMILARITY = 80  # hundredths
#: Estimates below this (hundredths) are hopeless: eight standard errors under 0.8.
ESTIMATE = 58
#: Sets smaller than this are confirmed without an estimate.
SMALL = 128

_RNG = np.random.default_rng(91)
_BORROW = np.argsort(_RNG.random((REGISTERS, REGISTERS)), axis=1).argsort(axis=1).astype(np.int16)  # rank of each bucket in each order
_BAND = np.stack([_RNG.permutation(REGISTERS)[:ROWS] for _ in range(BANDS)])
#: Pivots that the members of a block have met after each round; in the last one they meet all members.
PIVOTS = (2, 66)


def shingle_sets(texts: list[bytes], k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text (ASCII letters lower-cased)."""
    h, counts = word_hashes([t.lower() for t in texts])
    wide = runs(h, k)
    ends = np.cumsum(counts)
    for n, end in zip(counts.tolist(), ends.tolist(), strict=True):
        if n >= k:
            yield np.unique(wide[end - n : end - k + 1])
        elif n:
            with np.errstate(over="ignore"):
                yield mix(runs(h[end - n : end], n) + np.uint64(n))
        else:
            yield np.empty(0, dtype=np.uint64)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Compressed registers of a sorted, non-empty set."""
    bits = REGISTERS.bit_length() - 1
    bucket = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    filled = bucket[first]
    value = (hashes[first] << np.uint64(bits)) >> np.uint64(11)  # 53 bits, exact as a double
    zeros = 53 - np.frexp(value.astype(np.float64))[1].astype(np.int64)
    tail = (value << np.minimum(zeros + 1, 63).astype(np.uint64)) & np.uint64((1 << 53) - 1)
    out = np.zeros(REGISTERS, dtype=np.uint16)
    out[filled] = (zeros << MANTISSA) | (tail >> np.uint64(53 - MANTISSA)).astype(np.int64)
    if len(filled) < REGISTERS:
        empty = np.ones(REGISTERS, dtype=bool)
        empty[filled] = False
        gaps = np.flatnonzero(empty)
        out[gaps] = out[filled[_BORROW[gaps][:, filled].argmin(axis=1)]]
    return out


def band_keys(sketches: np.ndarray, bands: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band (the numbers of its registers) of each sketch."""
    wide = sketches.astype(np.uint64)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(mix(np.arange(1, len(bands) + 1, dtype=np.uint64)), (len(wide), len(bands)))
        for j in range(bands.shape[1]):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + wide[:, bands[:, j]])
    return key


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard estimates of rows of sketches: equal registers, less those that agree by chance.

    Minima of different elements agree in their leading zeros with probability
    near 1/3 and then in the mantissa with 2**-MANTISSA.
    """
    chance = 2.0**-MANTISSA / 3
    return np.clip(((a == b).mean(axis=1) - chance) / (1 - chance), 0, 1)


def features(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, tag (of the text), n_shingles, key (of the set; null if empty) and sketch."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=3_000_000):
            sizes, keys, packed = [], [], []
            for s in shingle_sets([t or b"" for t in raw(batch.column("text"))], k):
                sizes.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                packed.append(sketch(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tag"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(packed, pa.binary())],
                names=["doc_id", "tag", "n_shingles", "key", "sketch"],
            )

    return tagged(docs).mapInArrow(task, "doc_id bigint, tag bigint, n_shingles bigint, key binary, sketch binary")


def tagged(docs: DataFrame) -> DataFrame:
    return columns(docs, "doc_id", "text").withColumn("tag", F.xxhash64("text"))


def registers(sketches: list[bytes]) -> np.ndarray:
    """Registers [rows, REGISTERS] of packed sketches."""
    return np.frombuffer(b"".join(sketches), np.uint16).reshape(len(sketches), REGISTERS)


def banded(classes: DataFrame, bands: np.ndarray) -> DataFrame:
    """band, doc and n_shingles: a row for each band of each class."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                sketches = registers(part.column("sketch").to_pylist())
                docs, sizes = (np.repeat(part.column(c).to_numpy(), len(bands)) for c in ("doc", "n_shingles"))
                yield pa.RecordBatch.from_arrays([pa.array(band_keys(sketches, bands).view(np.int64).ravel()), pa.array(docs), pa.array(sizes)], names=["band", "doc", "n_shingles"])

    return classes.select("doc", "n_shingles", "sketch").mapInArrow(task, "band bigint, doc bigint, n_shingles bigint")


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc, tag and blob (the text, compressed) of the wanted (doc, tag), a row for each; all texts travel compressed to meet them."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in chunks(batches):
            blobs = [squeeze.compress(t or b"") for t in raw(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tag"), pa.array(blobs, pa.binary())], names=["doc", "tag", "blob"])

    small = tagged(docs).filter("doc_id IS NOT NULL").mapInArrow(task, "doc bigint, tag bigint, blob binary")
    met = small.join(wanted.hint("shuffle_hash"), ["doc", "tag"], "left_semi")
    return met.groupBy("doc", "tag").agg(F.first("blob").alias("blob"))  # repeated rows; the join has brought them together


def similar(pairs: DataFrame, k: int) -> DataFrame:
    """The pairs (a, b, _a, _b: compressed texts) whose full shingle sets are similar enough."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grow = zstandard.ZstdDecompressor()
        for batch in chunks(batches, "_a", limit=1_000_000):
            left, right = (list(shingle_sets([grow.decompress(x) for x in batch.column(c).to_pylist()], k)) for c in ("_a", "_b"))
            same = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(left, right, strict=True)]
            ok = [100 * i >= SIMILARITY * (len(x) + len(y) - i) and i > 0 for x, y, i in zip(left, right, same, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return pairs.select("a", "b", "_a", "_b").mapInArrow(task, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """node and component (least node reachable) for the nodes of edges (a, b); rounds of large-star and small-star."""
    now = checkpointed(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        near = large.join(least, "a")
        now = checkpointed(near.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").filter("a <> b").distinct())
        got = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
        if tuple(got) == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = tuple(got)


@F.pandas_udf(T.BooleanType())
def _hopeful(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(100 * estimate(registers(list(a)), registers(list(b))) >= ESTIMATE)


def _sized(a: str, b: str) -> Column:
    """Whether two set sizes allow the similarity."""
    return (100 * F.least(a, b)) >= SIMILARITY * F.greatest(a, b)


def confirmed(known: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """Those pairs (a, b) whose full sets are similar enough; known: doc, n_shingles, sketch and blob."""
    side = lambda c, *cols: known.select(F.col("doc").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in cols])
    met = pairs.join(side("a", "n_shingles", "sketch"), "a").join(side("b", "n_shingles", "sketch"), "b")
    sure = F.least("n_shingles_a", "n_shingles_b") < SMALL
    tried = checkpointed(met.filter(_sized("n_shingles_a", "n_shingles_b")).filter(sure | _hopeful("sketch_a", "sketch_b")).select("a", "b").distinct())
    both = tried.join(side("a", "blob"), "a").join(side("b", "blob"), "b")
    return checkpointed(similar(both.select("a", "b", F.col("blob_a").alias("_a"), F.col("blob_b").alias("_b")), k))


def buckets(classes: DataFrame, bands: np.ndarray) -> DataFrame:
    """band, doc, n_shingles and shared (the sum of the sizes of its buckets) of the classes that share a bucket with another."""
    members = banded(classes, bands)
    sizes = members.groupBy("band").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    met = checkpointed(members.join(sizes, "band"))
    totals = met.groupBy("doc").agg(F.sum("_n").alias("shared"))
    return checkpointed(met.drop("_n").join(totals, "doc"))


def stars(members: DataFrame) -> DataFrame:
    """Pairs (a, b): each member and, of the pivots of its buckets, the one that shares most.

    Pivots are the members that share most buckets with others: the text that
    others are copies of comes before the copies.
    """
    top = members.groupBy("band").agg(F.max(F.struct("shared", (-F.col("doc")).alias("least"), F.col("n_shingles").alias("n"))).alias("_p"))
    met = members.join(top, "band").filter((F.col("doc") != -F.col("_p.least")) & _sized("n_shingles", "_p.n"))
    return checkpointed(met.groupBy(F.col("doc").alias("a")).agg((-F.max(F.struct("_p.shared", "_p.least"))["least"]).alias("b")))


def crowded(members: DataFrame, parts: DataFrame, done: int) -> DataFrame:
    """members of the buckets with over `done` + 1 members, in two components at least, with their component (part)."""
    own = members.drop("part").join(parts.withColumnRenamed("node", "doc"), "doc", "left").withColumn("part", F.coalesce("component", "doc")).drop("component")
    split = own.groupBy("band").agg(F.min("part").alias("_lo"), F.max("part").alias("_hi"), F.count(F.lit(1)).alias("_n")).filter(f"_lo <> _hi AND _n > {done + 1}")
    return own.join(split.select("band"), "band", "left_semi")


def shingles(known: DataFrame, k: int) -> DataFrame:
    """h and doc: a row for each shingle of each class."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grow = zstandard.ZstdDecompressor()
        for batch in chunks(batches, "blob", limit=500_000):
            sets = list(shingle_sets([grow.decompress(x) for x in batch.column("blob").to_pylist()], k))
            docs = np.repeat(batch.column("doc").to_numpy(), [len(s) for s in sets])
            whole = pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64)), pa.array(docs)], names=["h", "doc"])
            for i in range(0, whole.num_rows, 100_000):
                yield whole.slice(i, 100_000)

    return known.select("doc", "blob").mapInArrow(task, "h bigint, doc bigint")


def blocks(known: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """band (a shingle), doc, n_shingles, shared and left of the members: the rare shingles by which they can be linked.

    Two sets of a similarity of S hundredths have S hundredths of the larger
    one in common at least. So if all shingles are put in one order, each set's
    first n - ceil(S n / 100) + 1 hold one that is among the first of the other.
    The order is by the number of members that have a shingle, rarest first: a
    set's own shingles, which link nothing, take the first places and need no
    row, and what many unlike texts share comes last. This is exact for sets of
    any size. `left` counts a set's shingles from the block's on: two sets whose
    first common shingle it is have no more in common than the smaller number.
    """
    some = members.select("doc", "n_shingles", "shared").distinct()
    rows = shingles(known.join(some.select("doc"), "doc", "left_semi"), k)
    counts = rows.groupBy("h").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1")
    met = rows.join(counts, "h").join(some, "doc")
    own = Window.partitionBy("doc")
    prefix = F.col("n_shingles") - F.ceil(F.lit(SIMILARITY) * F.col("n_shingles") / 100) + 1
    ranked = met.withColumn("_alone", F.col("n_shingles") - F.count(F.lit(1)).over(own)).withColumn("_r", F.row_number().over(own.orderBy("_c", "h")))
    return checkpointed(ranked.filter(F.col("_r") <= prefix - F.col("_alone")).select(F.col("h").alias("band"), "doc", "n_shingles", "shared", (F.col("n_shingles") - F.col("_alone") - F.col("_r") + 1).alias("left")))


def meetings(members: DataFrame, done: int, upto: int | None) -> DataFrame:
    """Pairs (a, b) of members with pivots of their block, those ranked over `done` up to `upto` (None: all members), in other components, that can have enough in common.

    Only pivots are ranked, and the limit on ranks holds in each task before rows meet.
    """
    top = members
    if upto is not None:
        order = Window.partitionBy("band").orderBy(F.desc("shared"), "doc")
        top = members.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= upto).filter(F.col("_r") > done)
    pivots = top.select(F.col("band").alias("_band"), F.col("doc").alias("b"), F.col("shared").alias("_s"), F.col("n_shingles").alias("_n"), F.col("part").alias("_p"), F.col("left").alias("_l"))
    common = (100 + SIMILARITY) * F.least("left", "_l") >= SIMILARITY * (F.col("n_shingles") + F.col("_n"))
    later = (F.col("shared") < F.col("_s")) | ((F.col("shared") == F.col("_s")) & (F.col("doc") > F.col("b")))
    met = members.join(pivots, (F.col("band") == F.col("_band")) & later & (F.col("part") != F.col("_p")) & _sized("n_shingles", "_n") & common)
    return met.select(F.col("doc").alias("a"), "b").distinct()


def joined(parts: DataFrame, links: DataFrame) -> DataFrame:
    """Components with these links as well."""
    return parts if links.isEmpty() else components(links.union(parts.select(F.col("node").alias("a"), F.col("component").alias("b"))))


def namesakes(linked: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of doc_ids that have several sets."""
    several = linked.groupBy("doc_id").agg(F.min("key").alias("_a"), F.max("key").alias("_b")).filter("_a <> _b").select("doc_id")
    own = linked.join(several, "doc_id", "left_semi").select("doc_id", "key").join(classes.select("key", "doc"), "key")
    return own.select(F.col("doc_id").alias("a"), F.col("doc").alias("b"))


def link(docs: DataFrame, k: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    feats = checkpointed(features(docs, k))
    linked = feats.filter("doc_id IS NOT NULL AND key IS NOT NULL")
    classes = checkpointed(
        linked.groupBy("key").agg(F.min(F.struct("doc_id", "tag")).alias("_f"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
        .select("key", F.col("_f.doc_id").alias("doc"), F.col("_f.tag").alias("tag"), "n_shingles", "sketch")
    )
    met = buckets(classes, _BAND)
    some = classes.join(met.select("doc").distinct(), "doc", "left_semi").drop("key")
    known = checkpointed(some.join(texts_of(docs, some.select("doc", "tag")), ["doc", "tag"]).drop("tag"))
    # copies join their text at once, by one comparison each
    tried = stars(met)
    parts = components(confirmed(known, tried, k).union(namesakes(linked, classes)))
    # then what shares a bucket in other components meets by its rare shingles
    rest, done = checkpointed(crowded(met, parts, 0)), 0
    if not rest.isEmpty():
        rest = checkpointed(crowded(blocks(known, rest, k), parts, 0))
    for upto in (*PIVOTS, None):
        if rest.isEmpty():
            break
        pairs = checkpointed(meetings(rest, done, upto).join(tried, ["a", "b"], "left_anti"))
        tried = tried.union(pairs)
        parts, done = joined(parts, confirmed(known, pairs, k)), upto
        rest = checkpointed(crowded(rest, parts, done)) if upto else rest
    named = classes.select("key", "doc").join(parts.withColumnRenamed("node", "doc"), "doc", "left").select(F.col("key").alias("_key"), F.coalesce("component", "doc").alias("_c"))
    out = feats.select("doc_id", "n_shingles", "key").join(named, F.col("key") == F.col("_key"), "left")
    part = F.when(F.col("doc_id").isNotNull(), F.coalesce("_c", "doc_id"))
    return out.select("doc_id", "n_shingles", part.alias("component_id"), F.coalesce(part == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep(docs: DataFrame, k: int = 5) -> DataFrame:
    """docs without the rows whose document isn't the first of its component (rows with one doc_id stay together)."""
    gone = link(docs, k).filter("NOT kept").select("doc_id").distinct()
    return docs.join(gone.hint("shuffle_hash"), "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op9_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "documents"), k=4)
