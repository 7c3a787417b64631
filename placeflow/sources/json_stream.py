"""Elements of JSON arrays and objects in files of any size: one task reads a file, in bounded memory."""

from __future__ import annotations

import codecs
import json
import re
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeflow import arrowfs

#: Bytes that are read at once, and bytes of files that a task should have.
CHUNK, TASK = 1 << 20, 64 << 20
#: Characters of a batch that goes on.
BATCH = 4 << 20
_SPACE = re.compile(r"[ \t\n\r]*")
#: What can follow a value in an array or object.
_AFTER = tuple(",]}: \t\n\r")
_DECODE = json.JSONDecoder().raw_decode

KIND = "file_path string, name string, pos int, key string, value string, ok boolean"


class _Text:
    """A window on a file's text, from the place that is being read to the end of the last chunk."""

    def __init__(self, file: BinaryIO):
        self.file, self.decoder = file, codecs.getincrementaldecoder("utf-8-sig")()
        self.text, self.at, self.ended = "", 0, False

    def more(self) -> None:
        # as much again as there is, so that a long element is tried a few times only
        data = self.file.read(max(CHUNK, len(self.text) - self.at))
        self.ended = not data
        self.text, self.at = self.text[self.at :] + self.decoder.decode(data, self.ended), 0

    def peek(self) -> str:
        """The next character that isn't a blank; empty at the end."""
        while True:
            self.at = _SPACE.match(self.text, self.at).end()
            if self.at < len(self.text) or self.ended:
                return self.text[self.at : self.at + 1]
            self.more()

    def take(self, char: str) -> None:
        if self.peek() != char:
            raise ValueError(f"expected {char}")
        self.at += 1

    def value(self) -> tuple[object, str]:
        """The next JSON value, and its text."""
        self.peek()
        while True:
            try:
                found, end = _DECODE(self.text, self.at)
            except json.JSONDecodeError as e:
                # the text may just end too early: in a string, or close to where the error is
                if self.ended or not (e.msg.startswith("Unterminated string") or e.pos >= len(self.text) - 16):
                    raise
            else:
                if self.ended or self.text[end : end + 1] in _AFTER or end < len(self.text) - 16:  # a number could go on
                    text = self.text[self.at : end]
                    self.at = end
                    return found, text
            self.more()


def elements(file: BinaryIO, array: bool) -> Iterator[tuple[str | None, object, str]]:
    """Key (null in arrays), value and text of the elements of one JSON array or object; ValueError if the file holds anything else.

    The text in memory is some chunks and the longest element.
    """
    text = _Text(file)
    text.take("[" if array else "{")
    end, first = "]" if array else "}", True
    while True:
        if first and text.peek() == end:
            break
        if not first:
            if text.peek() == end:
                break
            text.take(",")
        first, key = False, None
        if not array:
            if text.peek() != '"':
                raise ValueError("expected a key")
            key = text.value()[0]
            text.take(":")
        value, raw = text.value()
        yield key, value, raw
    text.at += 1
    if text.peek():
        raise ValueError("text after the end")


def _valid(store: arrowfs.Store, path: str, array: bool, objects: bool) -> int | None:
    """The number of elements; None if the file can't be read, or if an element that should be an object isn't."""
    try:
        n = 0
        with store.open(path) as f:
            for _, value, _ in elements(f, array):
                if objects and not isinstance(value, dict):
                    return None
                n += 1
        return n
    except (ValueError, OSError, RecursionError):  # bytes that aren't UTF-8 are a ValueError too
        return None


def _reading(array: bool, objects: bool, counts: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = None

        def out(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.string(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.bool_())
            names = ["file_path", "name", "pos", "key", "value", "ok"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for path, file_path, name in zip(*(batch.column(c).to_pylist() for c in ("path", "file_path", "name")), strict=True):
                store = store or arrowfs.Store(path)
                n = _valid(store, path, array, objects)
                if counts or n is None:
                    yield out([(file_path, name, n, None, None, n is not None)])
                    continue
                rows, held = [], 0
                with store.open(path) as f:
                    for pos, (key, _, text) in enumerate(elements(f, array)):
                        rows.append((file_path, name, pos, key, text, True))
                        held += len(text)
                        if held > BATCH:
                            yield out(rows)
                            rows, held = [], 0
                if rows:
                    yield out(rows)

    return task


def listed(spark: SparkSession, paths: list[str] | str, **options: object) -> DataFrame:
    """path, file_path (as a URI), name and length of files; listed by Spark, nothing read."""
    files = spark.read.format("binaryFile").options(**options).load(paths)
    return files.select("path", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("name"), "length")


def read(files: DataFrame, array: bool, objects: bool = True, counts: bool = False) -> DataFrame:
    """file_path, name, pos (from 0), key and value (JSON text) of the elements of files (as `listed`).

    A file that isn't one whole JSON array (or object), or with an element that
    isn't an object where those are asked for, gives a single row that isn't ok.
    So each file is read twice, first to see if it is whole. With counts, a row
    for each file: pos is its number of elements.
    """
    total = files.agg(F.sum("length"), F.count(F.lit(1))).first()
    tasks = max(1, min(total[1], max((total[0] or 0) // TASK, files.sparkSession.sparkContext.defaultParallelism)))
    return files.select("path", "file_path", "name").repartition(tasks).mapInArrow(_reading(array, objects, counts), KIND)


def _text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = []
        for path in batch.column("path").to_pylist():
            decoder = codecs.getincrementaldecoder("utf-8")()
            try:
                with arrowfs.Store(path).open(path) as f:
                    while data := f.read(CHUNK):
                        decoder.decode(data)
                decoder.decode(b"", True)
                good.append(True)
            except (ValueError, OSError):
                good.append(False)
        yield pa.RecordBatch.from_arrays([pa.array(good, pa.bool_())], names=["ok"])


def all_text(files: DataFrame) -> bool:
    """Whether all files (as `listed`) can be read and are UTF-8; read piece by piece."""
    return files.select("path").mapInArrow(_text, "ok boolean").filter("NOT ok").isEmpty()
