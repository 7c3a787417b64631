"""Readers: JSON trees, checkpoint maps, partition files, tables, and the fallback chain over them.

Paths go through Spark's file systems only, so any store that the cluster reads will do.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeflow import arrowfs, storage
from placeflow.schemas import ENRICHMENT, FACILITY, PATH_KEYS
from placeflow.sources import json_stream
from placeflow.storage import exists

PROGRESS_FILE = "progress.json"
_MISSING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def path_columns(df: DataFrame, root: str, path: str = "_path") -> DataFrame:
    """file_district, file_dong and file_keyword: the first two parts of each row's file path under root, and the file's name without its ending.

    What isn't there is the empty text.
    """
    decoded = F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B")))
    below = rf"\Q{root}\E/"
    return df.withColumns({
        "file_district": F.regexp_extract(decoded, below + "([^/]+)", 1),
        "file_dong": F.regexp_extract(decoded, below + "[^/]+/([^/]+)", 1),
        "file_keyword": F.regexp_extract(decoded, r"([^/]*?)(\.[^./]*)?$", 1),
    })


def bare_path(spark: SparkSession, path: str) -> str:
    """A path without scheme, host and closing slash, absolute in its file system."""
    return storage.located(spark, path)[0].toUri().getPath().rstrip("/")


def _elements(spark: SparkSession, paths: list[str] | str, array: bool, **options: object) -> DataFrame:
    """file_path, name, pos, key and value (JSON text) of the elements of whole files.

    Tasks read the files piece by piece where they can open them (`json_stream`);
    on a store that only Spark reads, a file is one row, and text after the
    array's end goes unnoticed.
    """
    first = [paths] if isinstance(paths, str) else paths
    if arrowfs.reachable(storage.qualified(spark, first[0])):
        return json_stream.read(json_stream.listed(spark, paths, **options), array).filter("ok").drop("ok")
    text = spark.read.options(**options).text(paths, wholetext=True)
    kind = "array<variant>" if array else "map<string, variant>"
    whole = F.try_variant_get(F.try_parse_json("value"), "$", kind)
    files = text.select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("name"), whole.alias("_v"))
    if array:
        files = files.filter(~F.exists("_v", lambda x: F.schema_of_variant(x).startswith("OBJECT") == F.lit(False)))
        rows = files.select("file_path", "name", F.posexplode("_v").alias("pos", "_e")).withColumn("key", F.lit(None).cast("string"))
    else:
        rows = files.select("file_path", "name", F.posexplode("_v").alias("pos", "key", "_e"))
    return rows.select("file_path", "name", "pos", "key", F.to_json("_e").alias("value"))


def json_tree(spark: SparkSession, root: str, schema: T.StructType = FACILITY) -> DataFrame:
    """Rows of the JSON arrays in all files under root, with the path's columns, file_path and pos (the row's place in its file).

    Files lie at root/district/dong/keyword.json or deeper; district and dong
    are the first two parts. Progress files, files in root itself, empty arrays
    and files that aren't an array of objects give no rows.
    """
    files = _elements(spark, root, True, recursiveFileLookup=True, pathGlobFilter="*.json").filter(F.col("name") != PROGRESS_FILE)
    placed = path_columns(files, bare_path(spark, root), "file_path").filter("file_dong <> ''")
    return placed.select(F.from_json("value", schema).alias("_row"), *PATH_KEYS, "file_path", "pos").select("_row.*", *PATH_KEYS, "file_path", "pos")


def file_report(spark: SparkSession, root: str) -> DataFrame:
    """file_path, extension, and how many elements a JSON file's array holds (null: no such array, or another kind of file), at any depth.

    Other files are listed, not read. The progress file doesn't count.
    """
    files = json_stream.listed(spark, root, recursiveFileLookup=True).filter(F.col("name") != PROGRESS_FILE)
    ending = F.regexp_extract("name", r"\.([^.]*)$", 1)
    counted = json_stream.read(files.filter(ending == "json"), True, objects=False, counts=True)
    counted = counted.select("file_path", ending.alias("extension"), F.col("pos").alias("n_rows"))
    return counted.unionByName(files.filter(ending != "json").select("file_path", ending.alias("extension"), F.lit(None).cast("int").alias("n_rows")))


def file_counts(spark: SparkSession, root: str) -> DataFrame:
    """Files and rows by extension: how many hold rows, how many are empty arrays, how many can't be read as an array."""
    known = F.col("extension") == "json"
    return file_report(spark, root).groupBy("extension").agg(
        F.count(F.lit(1)).alias("files"), F.count_if(F.col("n_rows") > 0).alias("processed"), F.count_if(F.col("n_rows") == 0).alias("empty"),
        F.count_if(known & F.col("n_rows").isNull()).alias("unreadable"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
    )


def checkpoint_map(spark: SparkSession, paths: list[str] | str, record: T.StructType = ENRICHMENT) -> DataFrame:
    """place_id, the record's fields, file_name and part (number in the file's name) of JSON object files {place_id: record}.

    Files that don't exist are passed over; without any, there are no rows. A file that isn't an object of objects gives none.
    """
    listed = [p for p in ([paths] if isinstance(paths, str) else paths) if "*" in p or exists(spark, p)]
    schema = T.StructType([T.StructField("place_id", T.StringType()), *record.fields, T.StructField("file_name", T.StringType()), T.StructField("part", T.IntegerType())])
    if not listed:
        return spark.createDataFrame([], schema)
    part = F.regexp_extract("name", r"_p(?:artition_)?(\d+)_of_", 1).try_cast("int")
    rows = _elements(spark, listed, False).select(F.col("key").alias("place_id"), F.from_json("value", record).alias("_r"), F.col("name").alias("file_name"), part.alias("part"))
    return rows.select("place_id", "_r.*", "file_name", "part")


def part_names(stem: str, total: int, suffix: str, width: int = 0) -> list[str]:
    """Names of all parts of a run: stem, number from 1, 'of' total."""
    return [f"{stem}{i:0{width}d}_of_{total:0{width}d}{suffix}" for i in range(1, total + 1)]


def parquet_parts(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """The parts that exist, by the declared schema, with part_no (from 1), and file_name and row_no (in the file) in the part; no rows without any.

    Parts of the same columns and types are one scan, whose files find their
    part's number in a broadcast table of a row for each part.
    """
    whole = T.StructType([*schema.fields, T.StructField("part_no", T.IntegerType()), T.StructField("file_name", T.StringType()), T.StructField("row_no", T.LongType())])
    alike: dict[tuple, list[tuple[str, str, int]]] = {}
    for i, p in enumerate(paths, 1):
        where, fs = storage.located(spark, p)
        if fs.exists(where):
            kind = (spark.read.parquet(p).schema.json(), fs.getFileStatus(where).isDirectory())
            alike.setdefault(kind, []).append((p, where.toUri().toString(), i))
    out = spark.createDataFrame([], whole)
    for (_, folder), parts in alike.items():
        rows = spark.read.parquet(*[p for p, _, _ in parts])
        cols = [(F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema]
        file = F.col("_metadata.file_path")
        typed = rows.select(*cols, (F.regexp_replace(file, "/[^/]*$", "") if folder else file).alias("_part"), F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.row_index").alias("row_no"))
        numbers = spark.createDataFrame([(_plain(uri), i) for _, uri, i in parts], "_part string, part_no int")
        out = out.unionByName(typed.withColumn("_part", F.regexp_replace("_part", "^file:/+", "file:/")).join(F.broadcast(numbers), "_part").drop("_part"))
    return out


def _plain(uri: str) -> str:
    """A URI with one slash after a scheme without host, as some writers have three."""
    return re.sub(r"^file:/+", "file:/", uri)


def csv_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A CSV with header; quoted line ends and a byte order mark are understood."""
    r = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8")
    return (r.schema(schema) if schema is not None else r).csv(path)


def csv_rows(spark: SparkSession, path: str) -> int:
    """Rows after the header; 0 if the file is missing or can't be read."""
    if not exists(spark, path):
        return 0
    try:
        if arrowfs.reachable(storage.qualified(spark, path)) and not json_stream.all_text(json_stream.listed(spark, path)):
            return 0
        return csv_table(spark, path).count()
    except PySparkException:
        return 0


def csv_lines(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The path's columns and n, the rows after the header, of all CSV files of that name under root; quoted line ends count as one row's."""
    table = spark.read.schema("_first string").options(header=True, multiLine=True, escape='"', recursiveFileLookup=True, pathGlobFilter=name, enforceSchema=True).csv(root)
    counts = table.groupBy(F.col("_metadata.file_path").alias("_path")).agg(F.count(F.lit(1)).alias("n"))
    return path_columns(counts, bare_path(spark, root)).drop("_path")


def required(df: DataFrame, *names: str) -> DataFrame:
    """df, or ValueError if a column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def mirrored(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet files of a mirrored dataset repository, wherever they lie under path; its cards and other files aren't read."""
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(path)


READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv": csv_table,
    "parquet": lambda spark, path: spark.read.parquet(path),
    "hub": mirrored,
}


def first_readable(spark: SparkSession, sources: list[tuple[str, str]]) -> DataFrame:
    """The first of (kind, path) that can be read; ValueError for an unknown kind, pickles (unsafe to load) or if none can."""
    for kind, path in sources:
        if kind == "pickle":
            raise ValueError("pickle files aren't read: loading one runs its code")
        if kind not in READERS:
            raise ValueError(f"unknown source: {kind}")
        if not exists(spark, path):
            continue
        try:
            return READERS[kind](spark, path)
        except AnalysisException as e:
            if e.getCondition() not in _MISSING:
                raise
    raise ValueError("no source can be read")


def cached(spark: SparkSession, path: str, fetch: Callable[[], DataFrame], force: bool = False) -> DataFrame:
    """The table at path; fetched and written there first if it's missing or force is set."""
    if force or not exists(spark, path):
        fetch().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def dimension(spark: SparkSession, districts: dict[str, list[str]]) -> DataFrame:
    """gu and dong rows of a mapping of districts to neighbourhoods."""
    kind = "gu string, dongs array<string>"
    return spark.createDataFrame(list(districts.items()), kind).select("gu", F.explode("dongs").alias("dong"))


def tasks(dim: DataFrame, keywords: list[str]) -> DataFrame:
    """A row for each neighbourhood and keyword (the keywords are a literal, so nothing is joined)."""
    return dim.withColumn("keyword", F.explode(F.array(*[F.lit(k) for k in keywords])))
