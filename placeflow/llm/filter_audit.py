"""Operator 13: audit of how five filters interact, by Shapley values of multilinear extensions.

Filters A to E (below) are bits of a mask. The documents of a part (a source)
are counted by mask; all that follows is made of those 32 counts:

* The removal polynomial of a part gives the documents that a set of filters
  removes, where x_i is 1 for a filter in the set: a mask m adds its count times
  1 - product of (1 - x_i) over i in m. Multiplied out, the monomial T has the
  coefficient (-1)^(|T|+1) times the count of all masks that contain T.
* Its values at the corners (0/1 vectors) are what sets of filters remove, so
  they give the survivors of each step of each order. Documents with good or
  toxic labels have polynomials of their own.
* A filter's Shapley value is the integral, along the diagonal x = (t, ..., t),
  of the polynomial's partial derivative: a monomial T with the filter gives its
  coefficient times the integral of t^(|T|-1), the rational 1/|T|. Scaled by
  120, the number of orders, all are whole numbers and the sum is exact.

Copies: a text's 128-bit digest stands for it. The least doc_id of each digest
is found by an aggregate, then the rows look for themselves by digest and doc_id
together, so a large group of copies is no hot key; equal rows are counted into
one before anything is joined.

A null text is the empty text: it fails A only, and E if an empty or null text
has a smaller doc_id. A row without a doc_id never fails E, makes no other row
fail it and has no label. Rows with equal doc_id and text are each counted and
neither fails E because of the other. A null source is the part of the empty
string. A document with several labels is good (toxic) if one of them is. An
empty table gives no rows, extra columns are ignored. A very long text is one
row of a batch, with some 60 bytes for each of its words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeflow.llm.common import checkpointed, chunks, columns, discarded, raw, table, written

FILTERS = "ABCDE"
FULL = 1 << len(FILTERS)
ORDERS = ["".join(p) for p in permutations(FILTERS)]
FEW_WORDS, DISTINCT, UPPER = 200, 50, 2
_UPPER, _MARKS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
_TAILS = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that begin no code point
MEASURES = ("n", "good", "toxic")


def failures(text: bytes) -> int:
    """Bits of the filters A to D that the text fails."""
    words = text.split()
    points = len(text.translate(None, _TAILS))
    bits = int(len(words) < FEW_WORDS)
    bits |= (100 * len(set(words)) < DISTINCT * len(words)) << 1
    bits |= (100 * (len(text) - len(text.translate(None, _UPPER))) > UPPER * points) << 2
    return bits | (len(text.translate(None, _MARKS)) < len(text)) << 3


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest and mask (A to D) of every document, and how many such rows there are."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            texts = [t or b"" for t in raw(batch.column("text"))]
            digests = pa.array([hashlib.blake2b(t, digest_size=16).digest() for t in texts], pa.binary())
            bits = pa.array(list(map(failures, texts)), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), digests, bits], names=["doc_id", "source", "digest", "mask"])

    rows = columns(docs, "doc_id", "source", "text").mapInArrow(task, "doc_id bigint, source string, digest binary, mask int")
    return rows.groupBy("doc_id", F.coalesce("source", F.lit("")).alias("part"), "digest", "mask").agg(F.count(F.lit(1)).alias("n"))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (A to E), and the number of documents, of good and of toxic ones: 32 rows a part at most."""
    rows = written(judged(docs))
    known = rows.filter("doc_id IS NOT NULL")
    first = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marks = [F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0))).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))]
    label = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(*marks)
    copied = known.join(first, ["digest", "doc_id"], "left").withColumn("mask", F.col("mask").bitwiseOR(F.when(F.col("first"), 0).otherwise(FULL >> 1)))
    named = copied.join(label, "doc_id", "left").select("part", "mask", "n", "good", "toxic")
    rest = rows.filter("doc_id IS NULL").select("part", "mask", "n", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    sums = [F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in MEASURES[1:]]
    out = checkpointed(named.unionByName(rest).groupBy("part", "mask").agg(F.sum("n").alias("n"), *sums))
    discarded(rows)
    return out


def _masks() -> Column:
    return F.sequence(F.lit(0), F.lit(FULL - 1))


def _summed(terms: Column, some) -> Column:
    """For each mask s the sum of the terms t for which some(t, s) holds."""
    return F.transform(_masks(), lambda s: F.aggregate(_masks(), F.lit(0).cast("bigint"), lambda a, t: a + F.when(some(t, s), F.get(terms, t)).otherwise(0)))


def polynomials(counts: DataFrame) -> DataFrame:
    """part, and for each measure its removal polynomial (coefficients by monomial) and the polynomial's values at the corners (by set of filters)."""
    entry = F.struct("mask", F.struct(*MEASURES).alias("v"))
    parts = counts.groupBy("part").agg(F.map_from_entries(F.collect_list(entry)).alias("by"))
    for c in MEASURES:
        by = F.transform_values("by", lambda _, v: v[c])  # noqa: B023  called at once
        parts = parts.withColumn(f"{c}_counts", F.transform(_masks(), lambda m: F.coalesce(F.try_element_at(by, m), F.lit(0)).cast("bigint")))  # noqa: B023
    for c in MEASURES:
        above = _summed(F.col(f"{c}_counts"), lambda m, t: m.bitwiseAND(t) == t)
        sign = lambda t: F.when(t == 0, 0).when(F.bit_count(t) % 2 == 1, 1).otherwise(-1)
        parts = parts.withColumn(f"{c}_terms", F.transform(above, lambda x, t: x * sign(t)))
    for c in MEASURES:
        parts = parts.withColumn(f"{c}_at", _summed(F.col(f"{c}_terms"), lambda t, s: t.bitwiseAND(s) == t))
    return parts.withColumn("total", F.aggregate("n_counts", F.lit(0).cast("bigint"), lambda a, x: a + x)).drop("by", *[f"{c}_counts" for c in MEASURES])


def shapley_weights() -> list[int]:
    """By size k of a monomial: the integral of t^(k-1) over [0, 1], times the number of orders."""
    weights = [Fraction(0), *[Fraction(1, k) * len(ORDERS) for k in range(1, len(FILTERS) + 1)]]
    assert all(w.denominator == 1 for w in weights)
    return [w.numerator for w in weights]


def audit(counts: DataFrame) -> DataFrame:
    """One row for each part, order and step."""
    weights = F.array(*[F.lit(w) for w in shapley_weights()])

    def bits(letters: Column) -> Column:
        return sum((F.when(F.instr(letters, f) > 0, 1 << i).otherwise(0) for i, f in enumerate(FILTERS)), F.lit(0))

    steps = (
        polynomials(counts)
        .withColumn("filter_order", F.explode(F.array(*[F.lit(o) for o in ORDERS])))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
        .withColumn("own", bits(F.substr("filter_order", F.col("step"), F.lit(1))))
        .withColumn("before", bits(F.substr("filter_order", F.lit(1), F.col("step") - 1)))
    )
    own, before = F.col("own"), F.col("before")
    after = own.bitwiseOR(before)

    def gained(measure: str) -> Column:
        return F.get(f"{measure}_at", after) - F.get(f"{measure}_at", before)

    shares = F.transform("n_terms", lambda c, t: F.when(t.bitwiseAND(own) == 0, 0).otherwise(c * F.get(weights, F.bit_count(t))))
    return steps.select(
        "part", "filter_order", "step",
        (F.col("total") - F.get("n_at", after)).alias("kept"),
        gained("n").alias("removed"),
        (F.get("n_at", own) - gained("n")).alias("redundant"),
        (F.get("n_at", F.lit(FULL - 1)) - F.get("n_at", F.lit(FULL - 1) - own)).alias("unique_fails"),
        gained("good").alias("good_lost"),
        gained("toxic").alias("toxic_lost"),
        F.aggregate(shares, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("shapley"),
    )


def op13_shapley_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(mask_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))
