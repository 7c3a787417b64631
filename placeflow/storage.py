"""Single files on any file system that Spark writes: whole or not at all, and at most once."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession


def located(spark: SparkSession, path: str):
    """The path, and its file system."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(where), fs


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system."""
    return located(spark, path)[0].toString()


def exists(spark: SparkSession, path: str) -> bool:
    where, fs = located(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    where, fs = located(spark, path)
    fs.delete(where, True)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none without it."""
    where, fs = located(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def write_text(spark: SparkSession, path: str, pieces: Iterable[str]) -> str:
    """One UTF-8 file; a crash can leave a part of it."""
    where, fs = located(spark, path)
    out = fs.create(where, True)
    try:
        for p in pieces:
            out.write(bytearray(p.encode()))
    finally:
        out.close()
    return path


def read_text(spark: SparkSession, path: str) -> str:
    where, fs = located(spark, path)
    stream = fs.open(where)
    try:
        jvm = spark.sparkContext._jvm
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _local(where) -> str | None:
    """The path on the driver's own disk; None elsewhere."""
    uri = where.toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def _written_beside(spark: SparkSession, path: str, pieces: Iterable[str]):
    where, fs = located(spark, path)
    fs.mkdirs(where.getParent())
    # a leading dot, so that listings of a table's files pass over it
    fresh = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{where.getName()}.{uuid.uuid4().hex}")
    if local := _local(fresh):  # without the checksum file that a rename would leave behind
        with open(local, "w", encoding="utf-8", newline="") as f:
            f.writelines(pieces)
            f.flush()
            os.fsync(f.fileno())
    else:
        write_text(spark, fresh.toString(), pieces)
    return where, fs, fresh


def _rename(spark: SparkSession, fresh, where, how: str) -> None:
    """A rename of Hadoop's FileContext: one step of the file system (HDFS and its like; object stores copy)."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(kind, 1)
    options[0] = kind.valueOf(how)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(fresh, where, options)


def replace(spark: SparkSession, path: str, pieces: Iterable[str]) -> str:
    """A file in the place of the one at path, if any: readers see the old one or the whole new one, and a crash leaves one of them."""
    where, fs, fresh = _written_beside(spark, path, pieces)
    if local := _local(where):
        checksum = os.path.join(os.path.dirname(local), f".{os.path.basename(local)}.crc")
        if os.path.exists(checksum):  # that of the old file
            os.remove(checksum)
        os.replace(_local(fresh), local)
    else:
        _rename(spark, fresh, where, "OVERWRITE")
    return path


def moved(spark: SparkSession, path: str, to: str) -> None:
    """Puts a file in the place of another, if there is one, in one step."""
    (fresh, _), (where, fs) = located(spark, path), located(spark, to)
    fs.mkdirs(where.getParent())
    _rename(spark, fresh, where, "OVERWRITE")


def put(spark: SparkSession, path: str, pieces: Iterable[str]) -> bool:
    """A new file at path; False, and nothing changed, if there is one already. Of several callers at once one succeeds."""
    where, fs, fresh = _written_beside(spark, path, pieces)
    try:
        if local := _local(where):
            os.link(_local(fresh), local)
            return True
        _rename(spark, fresh, where, "NONE")
        return True
    except FileExistsError:
        return False
    except Exception as e:  # noqa: BLE001  py4j wraps what Java throws
        if "FileAlreadyExistsException" in str(e):
            return False
        raise
    finally:
        fs.delete(fresh, False)


class Versions:
    """Documents numbered from 1 in a folder. The last one counts; each new one is put only if no other took its number."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def numbers(self) -> list[int]:
        return [int(n.partition(".")[0]) for n in names(self.spark, self.folder) if n.endswith(".json") and n[0] != "."]

    def path(self, number: int) -> str:
        return f"{self.folder}/{number:012d}.json"

    def at(self, number: int) -> dict:
        return json.loads(read_text(self.spark, self.path(number)))

    def last(self) -> tuple[int, dict | None]:
        """Number and document of the last version; 0 and None without any."""
        found = self.numbers()
        return (found[-1], self.at(found[-1])) if found else (0, None)

    def put(self, number: int, document: dict) -> bool:
        return put(self.spark, self.path(number), [json.dumps(document, ensure_ascii=False)])

    def forget(self, before: int) -> None:
        for n in self.numbers():
            if n < before:
                delete(self.spark, self.path(n))
