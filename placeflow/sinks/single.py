"""Single files of many rows: the tasks render the rows and write them, each at its place in the file."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from placeflow import arrowfs, storage
from placeflow.operators.partition import shared_folder
from placeflow.sinks.files import pretty


def _inside(value: object) -> str:
    return "\n".join("  " + x for x in pretty(value).split("\n"))


def _cell(v: object) -> str:
    return "" if v is None else '"' + str(v).replace('"', '""') + '"' if any(c in str(v) for c in ',"\n\r') else str(v)


def _rendered(df: DataFrame, render: Callable[[Row], str]) -> Column:
    # rows as collect() gives them, so that every type reads as it does there
    return F.udf(render, "string", useArrow=False)(F.struct(*[F.col(f"`{c}`") for c in df.columns]))


def json_array(df: DataFrame, path: str) -> str:
    """One file with a JSON array, indented by 2, other scripts unescaped."""
    rows = df.select(_rendered(df, lambda r: _inside(r.asDict(True))).alias("text"))
    return whole(rows, path, "[\n", ",\n", "\n]", "[]")


def json_map(df: DataFrame, path: str, key: str = "place_id") -> str:
    """One file with a JSON object: the rows of df by their key, in its order."""

    def render(r: Row) -> str:
        record = r.asDict(True)
        name = record.pop(key)
        return f"  {json.dumps(name, ensure_ascii=False)}: " + _inside(record).lstrip()

    ordered = df.orderBy(key)
    return whole(ordered.select(_rendered(ordered, render).alias("text")), path, "{\n", ",\n", "\n}", "{}")


def csv_with_mark(df: DataFrame, path: str, sort_columns: bool = True) -> str | None:
    """One CSV file that begins with a byte order mark, for spreadsheet programs; nothing without rows. Columns by name, or in df's order."""
    cols = sorted(df.columns) if sort_columns else df.columns
    rows = df.select(*[F.col(f"`{c}`") for c in cols])
    head = "\ufeff" + ",".join(map(_cell, cols)) + "\r\n"
    return whole(rows.select(_rendered(rows, lambda r: ",".join(map(_cell, r))).alias("text")), path, head, "\r\n", "\r\n", None)


def whole(rows: DataFrame, path: str, head: str, between: str, tail: str, empty: str | None) -> str | None:
    """A file of the texts of rows, in their order; `empty` (null: no file) without any. It takes its place at path in one step.

    The rendered rows are kept in the checkpoint folder. Their bytes are summed
    by partition, the sums before each partition give its offset, and each task
    writes its texts from there on: into the file itself on a local or mounted
    folder; elsewhere into a part, and the file system joins the parts (HDFS)
    without moving their bytes. Only on stores that can do neither the texts
    stream through the driver. A task that is run again writes the same bytes.
    """
    spark = rows.sparkSession
    shared_folder(spark)
    kept = rows.checkpoint()
    sizes = kept.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("n")).orderBy("p").collect()
    if not sizes:
        return None if empty is None else storage.replace(spark, path, [empty])
    gap, at, offsets = len(between.encode()), len(head.encode()), {}
    last = sizes[-1]["p"]
    for r in sizes:
        offsets[r["p"]] = at
        at += r["bytes"] + gap * (r["n"] - (r["p"] == last))
    where = storage.qualified(spark, path)
    beside = f"{where.rpartition('/')[0]}/.{where.rpartition('/')[2]}.{uuid.uuid4().hex}"
    if arrowfs.reachable(where) and arrowfs.Store(where).local:
        return _in_place(spark, kept, path, arrowfs.Store(where).bare(beside), offsets, at, head, between, tail, last)
    if arrowfs.reachable(where):
        try:
            return _joined(spark, kept, path, beside, [r["p"] for r in sizes], head, between, tail)
        except UnsupportedOperationException:
            pass
        finally:
            storage.delete(spark, beside)
    return storage.replace(spark, path, streamed(kept, head, between, tail))


def streamed(rows: DataFrame, head: str, between: str, tail: str) -> Iterator[str]:
    """The file's text, one row at a time."""
    first = True
    for row in rows.toLocalIterator():
        yield (head if first else between) + row["text"]
        first = False
    yield tail


def _texts(batches: Iterator[pa.RecordBatch], between: bytes, end: bool) -> Iterator[bytes]:
    """The texts of a partition, each followed by `between`; not the last one of the file (end)."""
    before = None
    for batch in batches:
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            if before is not None:
                yield before + between
            before = text
    if before is not None:
        yield before if end else before + between


def _in_place(spark: SparkSession, rows: DataFrame, path: str, fresh: str, offsets: dict[int, int], size: int, head: str, between: str, tail: str, last: int) -> str:
    os.makedirs(os.path.dirname(fresh), exist_ok=True)
    with open(fresh, "wb") as f:
        f.write(head.encode())
        f.seek(size)
        f.write(tail.encode())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = TaskContext.get().partitionId()
        if p in offsets:
            with open(fresh, "r+b") as f:
                f.seek(offsets[p])
                for text in _texts(batches, between.encode(), p == last):
                    f.write(text)
        yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32())], names=["p"])

    try:
        rows.mapInArrow(task, "p int").agg(F.count("p")).collect()
        target = arrowfs.Store(storage.qualified(spark, path)).bare(storage.qualified(spark, path))
        checksum = os.path.join(os.path.dirname(target), f".{os.path.basename(target)}.crc")
        if os.path.exists(checksum):  # that of the old file
            os.remove(checksum)
        os.replace(fresh, target)
    finally:
        if os.path.exists(fresh):
            os.remove(fresh)
    return path


def _joined(spark: SparkSession, rows: DataFrame, path: str, folder: str, parts: list[int], head: str, between: str, tail: str) -> str:
    last = parts[-1]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = TaskContext.get().partitionId()
        with arrowfs.Store(folder).create(f"{folder}/{p:08d}") as f:
            for text in _texts(batches, between.encode(), p == last):
                f.write(text)
        yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32())], names=["p"])

    rows.mapInArrow(task, "p int").agg(F.count("p")).collect()
    storage.write_text(spark, f"{folder}/head", [head])
    storage.write_text(spark, f"{folder}/tail", [tail])
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    names = [f"{folder}/{p:08d}" for p in parts] + [f"{folder}/tail"]
    array = gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(names))
    for i, n in enumerate(names):
        array[i] = jvm.org.apache.hadoop.fs.Path(n)
    where, fs = storage.located(spark, f"{folder}/head")
    fs.concat(where, array)
    storage.moved(spark, f"{folder}/head", path)
    return path
