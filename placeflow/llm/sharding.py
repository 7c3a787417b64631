"""Operator 4: reproducible shuffle into shards by a keyed permutation.

Law `rows`: shard sizes differ by one row at most. Rows are numbered over the
whole table in the order (doc_id, text crc32, size); a balanced Feistel network
on the smallest even number of bits that holds the count, walked along its
cycle until it falls below the count, permutes the numbers. The permuted number
p then gives shard p mod n and slot p div n, so both can be computed for any
row number (and undone) without reading the data.

Nulls: a null text counts as 0 bytes plus 1 and has crc32 0; a null doc_id
sorts first. Rows equal in all three sort columns are interchangeable, so the
result is the same multiset in any order. An empty table gives no rows.
Extra columns are ignored. Of a very long text only its size and checksum go
on, taken where it is read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeflow.llm.common import columns, shared_folder, table
from placeflow.operators.partition import row_index

ROUNDS = 6
SEED = 20240607


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit finaliser: multiply and shift, modulo 2**64."""
    with np.errstate(over="ignore"):
        x = (x ^ np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def _keys(seed: int) -> list[int]:
    return [int(k) for k in _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64), seed)]


def permute(numbers: np.ndarray, count: int, seed: int = SEED, inverse: bool = False) -> np.ndarray:
    """The keyed permutation of range(count) at `numbers`; inverse undoes it."""
    if count <= 1:
        return np.zeros_like(numbers, dtype=np.int64)
    half = np.uint64((int(count - 1).bit_length() + 1) // 2)
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = _keys(seed)[:: -1 if inverse else 1]
    x = np.asarray(numbers).astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):  # cycle walking: half of the numbers or more end in each turn, on average
        left, right = x[todo] >> half, x[todo] & mask
        for key in keys:
            if inverse:
                left, right = right ^ (_mix(left, key) & mask), left
            else:
                left, right = right, left ^ (_mix(right, key) & mask)
        x[todo] = (left << half) | right
        todo = todo[x[todo] >= np.uint64(count)]
    return x.astype(np.int64)


def permuted(number: Column, count: int, seed: int = SEED) -> Column:
    @F.pandas_udf(T.LongType())
    def apply(numbers: pd.Series) -> pd.Series:
        return pd.Series(permute(numbers.to_numpy(), count, seed))

    return apply(number)


def shard(docs: DataFrame, shards: int = 16, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + F.lit(1)
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    narrow = columns(docs, "doc_id", "text").select("doc_id", size.cast("bigint").alias("size"), crc.cast("bigint").alias("text_crc32"))
    shared_folder(docs.sparkSession)
    rows = row_index(narrow, ["doc_id", "text_crc32", "size"], "row_number")
    count = rows.count()
    place = rows.withColumn("_p", permuted(F.col("row_number"), count, seed))
    return place.select(
        "doc_id", "size", "text_crc32",
        F.pmod("_p", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("_p") / F.lit(shards)).cast("bigint").alias("slot"),
    )


def op4_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
