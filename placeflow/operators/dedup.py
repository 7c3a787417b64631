"""Deduplication by completeness, by first row, and by last writer. Every order is total, so results repeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def completeness(names: list[str], sentinels: tuple[str, ...] = ()) -> Column:
    """How many of the columns hold a value (sentinels count as none)."""
    one = lambda n: F.col(n).isNotNull() & ~F.coalesce(F.col(n).cast("string").isin(*sentinels), F.lit(False)) if sentinels else F.col(n).isNotNull()
    return sum((one(n).cast("int") for n in names), F.lit(0))


def most_complete(df: DataFrame, key: str, tie: list[str], scored: list[str] | None = None, sentinels: tuple[str, ...] = (), keep_unidentified: bool = False) -> DataFrame:
    """The most complete row of each key (null is a key), ties by the given order; keep_unidentified exempts null and 'N/A' keys."""
    score = completeness(scored or [c for c in df.columns if c not in (key, *tie)], sentinels)
    order = Window.partitionBy(key).orderBy(score.desc(), *tie)
    if not keep_unidentified:
        return df.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")
    named = F.coalesce(F.col(key) != "N/A", F.lit(False))
    best = df.filter(named).withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")
    return best.unionByName(df.filter(~named))


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def last_writer(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key. One partial aggregate per key, so a hot key is combined before the shuffle.

    Rows of equal order are told apart by their values, so every run picks the
    same one; values are looked at only where orders are equal.
    """
    rest = [c for c in df.columns if c not in keys]
    if any(_has_map(df.schema[c].dataType) for c in rest):  # maps have no order, their hash has
        tie = F.xxhash64(*[F.map_entries(c) if df.schema[c].dataType.typeName() == "map" else F.col(c) for c in rest])
        last = F.max_by(F.struct(*rest), F.struct(*order, tie))
    else:
        last = F.max(F.struct(*order, *[c for c in rest if c not in order]))
    return df.groupBy(*keys).agg(last.alias("_r")).select(*keys, *[F.col("_r")[c].alias(c) for c in rest])


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType) or (isinstance(kind, T.ArrayType) and _has_map(kind.elementType))


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """reported: rows less distinct non-null keys; removed: rows that deduplication takes away (nulls are one key)."""
    n, d = F.count(F.lit(1)), F.count_distinct(key)
    return df.agg((n - d).alias("reported"), (n - d - F.max(F.col(key).isNull().cast("int"))).alias("removed"))


def violations(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
