"""Repeatable samples: the order is a hash of the key and a seed, the same for any partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw(key: str, seed: int = 42) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def stratified(df: DataFrame, num: int, condition: Column, key: str, share: float = 0.6, seed: int = 42) -> DataFrame:
    """int(num * share) rows that meet the condition and the rest that don't, each as far as there are such rows.

    The first rows of a stratum are found by a limited window, which keeps only the quota in each task.
    """
    quota = int(num * share)
    rows = df.withColumn("stratum", F.coalesce(condition, F.lit(False)))
    order = Window.partitionBy("stratum").orderBy(draw(key, seed), key)
    ranked = rows.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= max(quota, num - quota))
    return ranked.filter(F.col("_n") <= F.when(F.col("stratum"), quota).otherwise(num - quota)).drop("_n")


def plain(df: DataFrame, num: int, key: str, seed: int = 42) -> DataFrame:
    return df.orderBy(draw(key, seed), key).limit(num)
