"""Trees of files, district/dong/keyword.json and .csv, written by the tasks through a data source."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from placeflow import arrowfs, storage
from placeflow.schemas import PATH_KEYS
from placeflow.sinks.single import _cell


@dataclass
class Written(WriterCommitMessage):
    """What a task has put in place."""

    files: int = 0


@dataclass
class _Part:
    """The pair of files of one keyword, while its rows arrive."""

    names: tuple[str, str]
    streams: list = field(default_factory=list)


class _Writer(DataSourceArrowWriter):
    """Writes each keyword's files into the job's own folder; a task that has written all of its files moves them to their places.

    So a task that fails or is killed leaves nothing but what lies in that
    folder, which goes with the job, whether it ends well or not. Run again, a
    task replaces its files by the same ones.
    """

    def __init__(self, options: dict):
        self.path, self.work, self.head = options["path"], options["work"], options["head"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, own = arrowfs.Store(self.path), f"{self.work}/{uuid.uuid4().hex}"
        now, part, done = None, None, []
        try:
            for batch in iterator:
                for key, j, c in zip(zip(*(batch.column(k).to_pylist() for k in PATH_KEYS), strict=True), *(batch.column(k).to_pylist() for k in "jc"), strict=True):
                    if key != now:
                        self._end(part)
                        now, part = key, _Part((f"{own}/{len(done)}.json", f"{own}/{len(done)}.csv"))
                        done.append(("/".join(key), j is not None))
                        part.streams.append(store.create(part.names[0]))
                        if j is None:  # tried without rows
                            part.streams[0].write(b"[]")
                            continue
                        part.streams[0].write(b"[\n")
                        part.streams.append(store.create(part.names[1]))
                        part.streams[1].write(("\ufeff" + self.head + "\r\n").encode())
                    else:
                        part.streams[0].write(b",\n")
                        part.streams[1].write(b"\r\n")
                    part.streams[0].write(j.encode())
                    part.streams[1].write(c.encode())
            self._end(part)
        except BaseException:
            if part is not None:
                for s in part.streams:
                    s.close()
            raise
        for i, (name, rows) in enumerate(done):
            for kind in ("json", "csv") if rows else ("json",):
                store.move(f"{own}/{i}.{kind}", f"{self.path}/{name}.{kind}")
        return Written(sum(2 if rows else 1 for _, rows in done))

    @staticmethod
    def _end(part: _Part | None) -> None:
        if part is not None:
            if len(part.streams) == 2:
                part.streams[0].write(b"\n]")
            for s in part.streams:
                s.close()

    def commit(self, messages: list[Written | None]) -> None:
        arrowfs.Store(self.path).delete_folder(self.work)

    def abort(self, messages: list[Written | None]) -> None:
        arrowfs.Store(self.path).delete_folder(self.work)


class KeywordTree(DataSource):
    """Options: path, work (a folder of the job's own), head (the CSV files' first line). Rows come sorted by their keys."""

    @classmethod
    def name(cls) -> str:
        return "keyword_tree"

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options)


def tree(df: DataFrame, path: str, status: DataFrame | None = None) -> str:
    """path/district/dong/keyword.json and .csv of df's rows (with the columns file_district, file_dong and file_keyword).

    JSON files hold an array of the rows without the path's columns or nulls;
    CSV files have a byte order mark and all columns by name. Each keyword that
    `status` (gu, dong, keyword) has without rows gets a JSON file with an empty
    array, so that it counts as tried. Rows are dealt by keyword and stream into
    its files, so a keyword of any size needs a row's memory; the driver handles
    no file. Names are taken as they are, so they must have no slash. Tasks must
    be able to open the folder (`arrowfs`).
    """
    spark, keys = df.sparkSession, [F.col(k) for k in PATH_KEYS]
    where = storage.qualified(spark, path).rstrip("/")
    cols = sorted(c for c in df.columns if c not in PATH_KEYS)
    nested = {c for c in cols if df.schema[c].dataType.typeName() in ("array", "struct", "map")}
    row = F.struct(*[F.col(f"`{c}`") for c in cols])
    flat = F.struct(*[(F.to_json(F.col(f"`{c}`")) if c in nested else F.col(f"`{c}`")).alias(c) for c in cols])
    lines = df.select(*keys, F.to_json(row, {"pretty": "true"}).alias("j"), F.to_csv(flat, {"quote": '"', "escape": '"', "quoteAll": "false"}).alias("c"), F.monotonically_increasing_id().alias("_at"))
    if status is not None:
        tried = status.select(*[F.col(a).alias(k) for a, k in zip(("gu", "dong", "keyword"), PATH_KEYS, strict=True)]).distinct()
        none = F.lit(None).cast("string")
        empty = tried.join(df.select(*keys).distinct(), PATH_KEYS, "left_anti")
        lines = lines.unionByName(empty.select(*keys, none.alias("j"), none.alias("c"), F.lit(0).cast("bigint").alias("_at")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = lines.repartition(parts, *keys).sortWithinPartitions(*keys, "_at").drop("_at")
    spark.dataSource.register(KeywordTree)
    work = f"{where}/_writing-{uuid.uuid4().hex}"
    ordered.write.format("keyword_tree").mode("append").options(path=where, work=work, head=",".join(map(_cell, cols))).save()
    return path
