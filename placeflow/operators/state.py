"""Resumable work on keyed state: an append-only log of records in numbered snapshots, read as the last record of each key."""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeflow import storage
from placeflow.operators.dedup import last_writer
from placeflow.operators.joins import pending
from placeflow.operators.partition import row_index, shared_folder

#: Records that a resumable run commits at once.
EVERY = 10_000
#: Tokens of appends that a snapshot remembers.
TOKENS = 1000


class Log:
    """Records under one folder, as Parquet folders (path/data) that snapshots (path/snapshots) name.

    A snapshot is a small numbered document: its folders, the last `seq` and the
    tokens of the last appends. Writers write a folder, then put the next
    snapshot; whoever finds its number taken starts from the new last one, so
    appends and compactions can run beside each other and none is lost. Readers
    pin the snapshot they find: `vacuum` alone removes folders. What a crash
    leaves is a folder that no snapshot names.

    Records are ordered by `seq`, a clock in microseconds that never goes back
    behind the snapshot that an append starts from, then by batch. Of two
    appends at once either can be the later one.
    """

    def __init__(self, spark: SparkSession, path: str, record: T.StructType, key: str = "place_id", error: str | None = None):
        self.spark, self.path, self.key, self.error = spark, path.rstrip("/"), key, error
        self.snapshots = storage.Versions(spark, f"{self.path}/snapshots")
        self.schema = T.StructType([T.StructField(key, T.StringType()), *[f for f in record if f.name != key], T.StructField("seq", T.LongType()), T.StructField("batch", T.StringType())])

    def all(self, number: int | None = None) -> DataFrame:
        """The records of the last snapshot, or of one that vacuum has kept."""
        document = self.snapshots.last()[1] if number is None else self.snapshots.at(number)
        return self._read(document["folders"] if document else [])

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/data/{f}" for f in folders])

    def current(self) -> DataFrame:
        """The last record of each key."""
        return last_writer(self.all(), [self.key], ["seq", "batch"]).drop("seq", "batch")

    def append(self, records: DataFrame, token: str | None = None) -> bool:
        """Adds the records as one batch; False, and nothing added, if a batch with this token is in the log."""
        document = self.snapshots.last()[1] or {"folders": [], "seq": 0, "tokens": []}
        if token is not None and token in document["tokens"]:
            return False
        batch = uuid.uuid4().hex
        seq = max(time.time_ns() // 1000, document["seq"] + 1)
        cols = [f.name for f in self.schema if f.name not in ("seq", "batch")]
        have = records.select(*[(F.col(c) if c in records.columns else F.lit(None)).cast(self.schema[c].dataType).alias(c) for c in cols])
        have.withColumns({"seq": F.lit(seq).cast("bigint"), "batch": F.lit(batch)}).write.parquet(f"{self.path}/data/{batch}")
        while True:
            number, document = self.snapshots.last()
            document = document or {"folders": [], "seq": 0, "tokens": []}
            if token is not None and token in document["tokens"]:
                storage.delete(self.spark, f"{self.path}/data/{batch}")
                return False
            tokens = [*document["tokens"], *([] if token is None else [token])][-TOKENS:]
            if self.snapshots.put(number + 1, {"folders": [*document["folders"], batch], "seq": max(seq, document["seq"]), "tokens": tokens}):
                return True

    def pending(self, items: DataFrame, retry_errors: bool = False) -> DataFrame:
        """items without a record; with retry_errors, a record that is an error doesn't count."""
        done = self.current()
        if retry_errors and self.error:
            done = done.filter(F.col(self.error).isNull())
        return pending(items, done, self.key)

    def compact(self) -> None:
        """Puts the last record of each key in the place of the folders that it found. Batches appended meanwhile stay beside it."""
        document = self.snapshots.last()[1]
        if document is None or len(document["folders"]) < 2:
            return
        old, fresh = document["folders"], f"compact-{uuid.uuid4().hex}"
        last_writer(self._read(old), [self.key], ["seq", "batch"]).select(*self.schema.names).write.parquet(f"{self.path}/data/{fresh}")
        while True:
            number, document = self.snapshots.last()
            if not set(old) <= set(document["folders"]):  # another compaction was first
                storage.delete(self.spark, f"{self.path}/data/{fresh}")
                return
            rest = [f for f in document["folders"] if f not in old]
            if self.snapshots.put(number + 1, {**document, "folders": [fresh, *rest]}):
                return

    def vacuum(self, keep: int = 1, older_than: float = 86_400) -> None:
        """Removes all snapshots but the last `keep`, and folders that none of those names.

        Folders younger than `older_than` seconds stay: their append may not have put its snapshot yet.
        """
        numbers = self.snapshots.numbers()[-keep:]
        named = {f for n in numbers for f in self.snapshots.at(n)["folders"]}
        where, fs = storage.located(self.spark, f"{self.path}/data")
        if numbers:
            self.snapshots.forget(numbers[0])
        if fs.exists(where):
            for s in fs.listStatus(where):
                if s.getPath().getName() not in named and time.time() - s.getModificationTime() / 1000 >= older_than:
                    fs.delete(s.getPath(), True)


def run(items: DataFrame, log: Log, work: Callable[[DataFrame], DataFrame], retry_errors: bool = False, every: int = EVERY) -> DataFrame:
    """Does the work for the pending items, `every` at a time, and appends the records of each batch before the next one starts.

    So a crash costs the batch it falls into, and running again does only what
    has no record yet. The pending items are written as files of at most `every`
    neighbouring keys, and a stream takes them one by one; a batch that Spark
    repeats is known by its token and not added twice. An error of `work` ends the
    run after the batches before it are in the log. Running again after the end
    changes nothing.
    """
    spark, where, name = log.spark, f"{log.path}/work/{uuid.uuid4().hex}", uuid.uuid4().hex
    shared_folder(spark)
    todo = log.pending(items, retry_errors).checkpoint()
    files = math.ceil(todo.count() / every)
    if files:
        try:
            todo.repartitionByRange(files, log.key).sortWithinPartitions(log.key).write.option("maxRecordsPerFile", every).parquet(f"{where}/items")
            stream = spark.readStream.schema(todo.schema).option("maxFilesPerTrigger", 1).parquet(f"{where}/items")
            write = stream.writeStream.foreachBatch(lambda batch, number: log.append(work(batch), f"{name}-{number}") and None)
            write.option("checkpointLocation", f"{where}/checkpoint").trigger(availableNow=True).start().awaitTermination()
        finally:
            storage.delete(spark, where)
    return log.current()


def merged(parts: DataFrame, key: str = "place_id", order: str = "part") -> DataFrame:
    """State of several workers as one: the record of the last part wins."""
    return last_writer(parts, [key], [order])


def one_run(parts: DataFrame, names: str = "file_name") -> DataFrame:
    """parts, or ValueError if their file names tell of runs with different numbers of workers."""
    totals = parts.select(F.regexp_extract(names, r"_of_(\d+)", 1).alias("t")).distinct().limit(2).collect()
    if len(totals) > 1:
        raise ValueError("parts of runs with different totals")
    return parts


def incomplete_tasks(tasks: DataFrame, completed: DataFrame, hits: DataFrame, least: int = 40) -> DataFrame:
    """Tasks (gu, dong, ...) neither completed nor with at least so many hits."""
    enough = hits.groupBy("gu", "dong").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= least).select("gu", "dong")
    return tasks.join(completed.select("gu", "dong").union(enough).distinct(), ["gu", "dong"], "left_anti")


def run_tasks(tasks: DataFrame, search: Callable[[str, str, str], int], weight: Column | None = None) -> DataFrame:
    """A summary for each task (gu, dong, keywords): each keyword is tried, a failure is kept as data.

    Every row is a Spark task of its own, so a slow one holds no other, and an
    idle core takes the next. The heaviest come first (by `weight`, else by the
    number of keywords), so that the last to end is a short one. The rows are
    numbered in that order and dealt by number; they are narrow, and a task is a
    search, so a scheduled task costs little beside it.
    """
    import pandas as pd

    from placeflow.schemas import SUMMARY

    def task(frames):
        for f in frames:
            out = []
            for t in f.itertuples():
                row = {"gu": t.gu, "dong": t.dong, "completed_keywords": [], "failed_keywords": [], "total_facilities": 0, "start_time": _now(), "end_time": None, "error": None}
                for word in t.keywords:
                    try:
                        row["total_facilities"] += search(t.gu, t.dong, word)
                        row["completed_keywords"].append(word)
                    except Exception as e:  # noqa: BLE001  failures are data here
                        row["failed_keywords"].append(word)
                        row["error"] = str(e)
                out.append(row | {"end_time": _now()})
            yield pd.DataFrame(out, columns=SUMMARY.names)

    heavy = F.size("keywords") if weight is None else weight
    numbered = row_index(tasks.select("gu", "dong", "keywords", (-heavy).alias("_w")), ["_w", "gu", "dong"], "_n")
    dealt = numbered.repartitionById(max(1, numbered.count()), F.col("_n").cast("int"))
    return dealt.select("gu", "dong", "keywords").mapInPandas(task, SUMMARY)


def _now() -> str:
    return datetime.now().isoformat()
