"""Joins with defaults. Sides are joined as they are; the optimiser broadcasts one only within its size threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeflow.functions.text import clean_id


def left_defaults(left: DataFrame, right: DataFrame, key: str, defaults: dict[str, object]) -> DataFrame:
    """left with right's columns by the canonical text of the key; null keys never match, missing values take the defaults."""
    r = right.withColumn("_key", clean_id(key)).drop(key)
    out = left.withColumn("_id", clean_id(key)).join(r, F.col("_id") == F.col("_key"), "left").drop("_id", "_key")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def first_match(left: DataFrame, right: DataFrame, key: str, value: str, order: list[str], default: str = "Unknown") -> DataFrame:
    """left with the value of the first row of right with its key, or the default."""
    one = right.filter(F.col(key).isNotNull()).groupBy(clean_id(key).alias("_key")).agg(F.min_by(F.struct(value), F.struct(*order)).alias("_v"))
    out = left.withColumn("_id", clean_id(key)).join(one, F.col("_id") == F.col("_key"), "left")
    return out.withColumn(value, F.coalesce(F.col(f"_v.{value}"), F.lit(default))).drop("_id", "_key", "_v")


def pending(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """items whose key isn't among those done (null keys are pending)."""
    return items.join(done.select(key).distinct(), key, "left_anti")


def members(items: DataFrame, other: DataFrame, key: str) -> DataFrame:
    return items.join(other.select(key), key, "left_semi")


def counted(items: DataFrame, events: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """items with the number of non-null values of their events; null without any event."""
    return items.join(events.groupBy(key).agg(F.count(value).alias(name)), key, "left")


def not_same(c: Column, value: str) -> Column:
    """c differs from the value; null does."""
    return ~c.eqNullSafe(F.lit(value))
