"""Session settings that results depend on, and those that plans profit from."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build(app: str = "placeflow", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with UTC times and adaptive plans; the cluster's own settings hold elsewhere."""
    b = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()
