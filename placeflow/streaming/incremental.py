"""Streams over arriving files: keyed upsert into a log, and windows over events (beyond the batch flows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from placeflow.operators.dedup import last_writer
from placeflow.operators.state import Log


def arriving(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def upsert(stream: DataFrame, log: Log, order: list[str], checkpoint: str) -> StreamingQuery:
    """Appends the last record of each key of every batch to the log, until no file is left; starts again where it ended."""

    def write(batch: DataFrame, _: int) -> None:
        log.append(last_writer(batch, [log.key], order))

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed(events: DataFrame, time: str, value: str, width: str = "1 hour", slide: str | None = None, late: str = "1 hour", *keys: str) -> DataFrame:
    """Count and sum in tumbling (or sliding) windows; for streams, rows later than `late` are dropped by the watermark."""
    w = F.window(time, width, slide) if slide else F.window(time, width)
    grouped = events.withWatermark(time, late).groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return grouped.select(F.col("w.start").alias("start"), F.col("w.end").alias("stop"), *keys, "n", "total")


def sessions(events: DataFrame, time: str, key: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    grouped = events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    return grouped.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("stop"), "n")


def first_seen(stream: DataFrame, time: str, keys: list[str], late: str = "1 hour") -> DataFrame:
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)
