"""Shared pieces of the training-data operators: paths, word rule, checkpoints."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of characters other than these six ASCII blanks.
BLANKS = r"[\x20\x09-\x0D]+"
BLANK_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns(docs: DataFrame, *names: str) -> DataFrame:
    """Only the named columns; missing ones become null, extra or clashing ones go."""
    kinds = {"doc_id": "bigint", "text": "string"}
    have = set(docs.columns)
    return docs.select(*[(F.col(f"`{n}`") if n in have else F.lit(None)).cast(kinds.get(n, "string")).alias(n) for n in names])


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n (null id: as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def words(text: Column) -> Column:
    """Array of the words of a text (null or blank: empty array)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster shares (spark.checkpoint.dir). Only a local session without one gets a temporary folder."""
    jsc = spark.sparkContext._jsc.sc()
    if not jsc.getCheckpointDir().isDefined():
        where = spark.conf.get("spark.checkpoint.dir", None)
        if where is None:
            if not re.match(r"local($|\[)", spark.sparkContext.master):
                raise RuntimeError("spark.checkpoint.dir names no folder that the cluster shares")
            where = tempfile.mkdtemp(prefix="placeflow-")
        spark.sparkContext.setCheckpointDir(where)
    return jsc.getCheckpointDir().get()


@contextmanager
def _shuffles_go(spark: SparkSession) -> Iterator[None]:
    """What runs in here leaves no shuffle files: its rows are kept, so nothing reads them again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """df, computed once and kept as a Parquet table in the shared folder: for wide rows, which a checkpoint keeps unpacked."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    with _shuffles_go(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discarded(df: DataFrame) -> None:
    """Removes the table that `written` made of df, once nothing reads it any more."""
    for file in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def least(df: DataFrame, key: str, n: int) -> Column:
    """A condition on df that holds for the rows with the n least hashes of the key (rows with one key stay together).

    Only keys travel to find the bound. A first filter by the expected share
    leaves about 2n of them in all, so what meets in the last task doesn't grow
    with the number of partitions.
    """
    draw, top = F.pmod(F.xxhash64(key), F.lit(1 << 31)), 1 << 31
    total = df.count()
    if total <= n:
        return F.lit(True)
    some = df.filter(draw < int(2 * n / total * top)) if total > 2 * n else df
    last = some.select(draw.alias("d")).distinct().orderBy("d").limit(n).agg(F.max("d")).first()[0]
    return draw <= (top if last is None else last)


def commonest(counts: DataFrame, word: str, n: int) -> DataFrame:
    """The n rows with the largest column n (ties by word).

    A histogram of the counts' logarithms gives a bound below which no such row
    lies; few rows more than n pass it, whatever the number of partitions.
    """
    step = F.floor(F.log2("n") * 16)
    bars = counts.groupBy(step.alias("_b")).agg(F.count(F.lit(1)).alias("_c")).orderBy(F.desc("_b")).collect()  # a thousand rows at most
    seen, least = 0, None
    for b in bars:
        seen, least = seen + b["_c"], b["_b"]
        if seen >= n:
            break
    some = counts.filter(step >= least) if least is not None else counts
    return some.orderBy(F.desc("n"), word).limit(n)


def raw(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding it."""
    return column.cast(pa.binary()).to_pylist()


def release() -> None:
    """Gives memory that a worker process has freed back to the system; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not this C library
        pass


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about `limit` text bytes (one row at least)."""
    release()
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        mean = max(1, batch.column(column).nbytes // n)
        step = max(1, limit // mean)
        for i in range(0, n, step):
            yield batch.slice(i, step)
    release()
