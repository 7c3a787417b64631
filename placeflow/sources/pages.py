"""Captured pages as the source of what a live collector would fetch: lookups by place and search results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from placeflow.functions import html, text
from placeflow.operators.partition import shared_folder

#: Keys that a lookup broadcasts; more of them are joined by a shuffle. Resumable runs ask for fewer at once.
BROADCAST_KEYS = 200_000
#: Bytes of a row group of a store: what a lookup of one key reads at least.
GROUP = 8 << 20


class Store:
    """Pages as a Parquet table with one row for each place, sorted by place, in small row groups.

    A lookup of neighbouring keys reads the row groups whose range of keys
    meets theirs, and no page moves between executors.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @classmethod
    def write(cls, pages: DataFrame, path: str, files: int | None = None, group: int = GROUP) -> Store:
        """Stores pages (url, html): the first by url of each place, then by the page itself; pages without a place's number are left out."""
        parts = files or int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        found = pages.select(text.place_id("url").alias("place_id"), "url", "html").filter("place_id IS NOT NULL")
        place = Window.partitionBy("place_id").orderBy("url", F.col("html").asc_nulls_last())
        one = found.repartitionByRange(parts, "place_id").withColumn("_n", F.row_number().over(place)).filter("_n = 1").drop("_n")
        # Parquet looks at a group's size after each hundred rows or more, and pages are long
        options = {"parquet.block.size": group, "parquet.page.size.row.check.min": 1, "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 100}
        one.sortWithinPartitions("place_id").write.options(**options).parquet(path)
        return cls(pages.sparkSession, path)

    def read(self) -> DataFrame:
        return self.spark.read.schema("place_id string, url string, html string").parquet(self.path)


def lookup(keys: DataFrame, pages: DataFrame | Store) -> DataFrame:
    """keys (place_id, ...) with the html of their page (the first by url if several); null html is a miss."""
    return _stored(keys, pages) if isinstance(pages, Store) else _scanned(keys, pages)


def _kept(keys: DataFrame) -> DataFrame:
    """keys (narrow rows), computed once."""
    shared_folder(keys.sparkSession)
    return keys.checkpoint()


def _stored(keys: DataFrame, store: Store) -> DataFrame:
    """From a store: the keys' range reaches the row groups' statistics, and pages meet broadcast keys where they are read."""
    keys = _kept(keys)
    n, low, high = keys.agg(F.count("place_id"), F.min("place_id"), F.max("place_id")).first()
    pages = store.read().filter(F.col("place_id").between(low, high)).select("place_id", "html")
    if n > BROADCAST_KEYS:
        return keys.join(pages, "place_id", "left")
    hits = pages.join(F.broadcast(keys), "place_id").select(*keys.columns, "html")
    misses = keys.join(pages.select("place_id"), "place_id", "left_anti")
    return hits.unionByName(misses.withColumn("html", F.lit(None).cast("string")))


def _scanned(keys: DataFrame, pages: DataFrame) -> DataFrame:
    """From any table of pages: first the URLs of the keys' pages, then the HTML of those alone."""
    keys = _kept(keys)
    wanted = keys.select("place_id").filter("place_id IS NOT NULL").distinct()
    few = keys.count() <= BROADCAST_KEYS
    narrow = pages.select(text.place_id("url").alias("place_id"), "url").filter("place_id IS NOT NULL")
    chosen = narrow.join(F.broadcast(wanted) if few else wanted, "place_id", "left_semi").groupBy("place_id").agg(F.min("url").alias("url"))
    found = pages.select("url", "html").join(F.broadcast(chosen) if few else chosen, "url")
    # a URL that was captured several times gives one page
    one = found.groupBy("place_id").agg(F.min("html").alias("html"))
    return keys.join(one, "place_id", "left")


def search_hits(pages: DataFrame, max_pages: int | None = None, by: tuple[str, ...] = ("search_query", "search_location")) -> DataFrame:
    """Rows of search result pages (search_query, search_location, page_number, html): the list items with a name not seen before, and their position.

    A name counts once for each search (the columns `by`), at its first page and place.
    A page whose last paging button is disabled ends its search. Each page is
    parsed once, and only what was read of it goes on.
    """
    if max_pages is not None:
        pages = pages.filter(F.col("page_number") <= max_pages)
    keys = list(by)
    seen = pages.select(*keys, "page_number", html.read_search_page("html")["value"].alias("_r"))
    ends = F.when(~F.coalesce(F.col("_r.more"), F.lit(True)), F.col("page_number"))
    last = F.min(ends).over(Window.partitionBy(*keys))
    shown = seen.withColumn("_last", last).filter("_last IS NULL OR page_number <= _last")
    items = shown.select(*keys, "page_number", F.posexplode("_r.items").alias("_at", "_i"))
    named = items.select(*keys, "page_number", "_at", F.col("_i.name").alias("preview_name"), F.col("_i.href").alias("url"))
    first = named.withColumn("_n", F.row_number().over(Window.partitionBy(*keys, "preview_name").orderBy("page_number", "_at"))).filter("_n = 1")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("page_number", "_at"))
    return first.withColumn("position", place).drop("_n", "_at")


def details(pages: DataFrame) -> DataFrame:
    """Facility fields of place pages (url, html), with place_id and error."""
    read = pages.withColumn("_r", html.read_facility("html"))
    return read.select("url", "_r.value.*", F.coalesce(text.place_id("url"), F.lit("N/A")).alias("place_id"), F.col("_r.error").alias("error"))
