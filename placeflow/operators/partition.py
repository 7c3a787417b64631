"""Stable row numbers and the two ways of dealing rows to workers."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_index(df: DataFrame, order: list[str], name: str = "row_index") -> DataFrame:
    """Gapless numbers from 0 in the given order; rows of equal order by a hash of all their values.

    So two runs number the same table alike, and a key that many rows share is
    split over ranges. Rows equal in every column can change places, so they are
    split as well, by where they are read. Rows are range-partitioned and sorted; each range's
    count (one row for each partition, joined by broadcast) gives the next one's
    offset. No task sees all rows, and the plan doesn't grow with the partitions. The ranged rows are kept in the checkpoint folder, so that a
    second pass or a lost executor can't cut other ranges.
    """
    spark = df.sparkSession
    shared_folder(spark)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tie = F.xxhash64(*[F.map_entries(f.name) if f.dataType.typeName() == "map" else F.col(f"`{f.name}`") for f in df.schema])
    place = [*order, "_tie", "_at"]
    cut = df.withColumns({"_tie": tie, "_at": F.monotonically_increasing_id()}).repartitionByRange(parts, *place).sortWithinPartitions(*place)
    placed = cut.drop("_tie", "_at").withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    counts = placed.groupBy(F.shiftright("_id", 33).alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
    # one row for each partition
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_p", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_first"))
    numbered = placed.withColumn("_p", F.shiftright("_id", 33)).join(F.broadcast(offsets), "_p")
    return numbered.withColumn(name, (F.col("_first") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).cast("bigint")).drop("_id", "_p", "_first")


def shared_folder(spark) -> None:
    """Sets the checkpoint folder to the one that the cluster names; only a local session without one gets a temporary folder."""
    if spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        return
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where is None:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir names no folder that the cluster shares")
        where = tempfile.mkdtemp(prefix="placeflow-")
    spark.sparkContext.setCheckpointDir(where)


def check(x: int, y: int) -> None:
    if y < 1 or not 1 <= x <= y:
        raise ValueError(f"part {x} of {y}: need 1 <= part <= total")


def modulo(df: DataFrame, order: list[str], x: int, y: int) -> DataFrame:
    """Rows whose number leaves x (from 0) when divided by y."""
    return row_index(df, order).filter(F.col("row_index") % y == x)


def stride(df: DataFrame, order: list[str], x: int, y: int) -> DataFrame:
    """Part x (from 1) of y: numbers x-1, x-1+y, ..."""
    check(x, y)
    return row_index(df, order).filter(F.col("row_index") % y == x - 1)


def slice_then_filter(df: DataFrame, order: list[str], x: int, y: int, condition: Column) -> DataFrame:
    return modulo(df, order, x, y).filter(condition)


def filter_then_slice(df: DataFrame, order: list[str], x: int, y: int, condition: Column) -> DataFrame:
    return stride(df.filter(condition), order, x, y)


def round_robin(df: DataFrame, order: list[str], workers: int) -> DataFrame:
    """df with worker, dealt in turn."""
    return row_index(df, order).withColumn("worker", (F.col("row_index") % workers).cast("int"))


def row_range(df: DataFrame, order: list[str], start: int, stop: int) -> DataFrame:
    return row_index(df, order).filter((F.col("row_index") >= start) & (F.col("row_index") < stop))


def share(df: DataFrame, condition: Column) -> DataFrame:
    """Rows, rows that meet the condition, and their percentage (null for an empty table)."""
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(condition).alias("part"), F.try_divide(100.0 * F.count_if(condition), F.count(F.lit(1))).alias("percent"))


def ordinal(keys: list[str], order: list[str]) -> Column:
    """Running number from 1 within keys."""
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
