"""The four flows: publish, enrich, reviews, merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeflow import storage
from placeflow.functions import html, text
from placeflow.operators import dedup, flatten, joins, partition, sampling, state, stats
from placeflow.schemas import BUNDLE, ENRICHMENT, ERRORS, FACILITY, FLAT_REVIEW, NOT_FOUND, PATH_KEYS
from placeflow.settings import Settings
from placeflow.sinks import files as sinks
from placeflow.sinks import single
from placeflow.sinks import tree as trees
from placeflow.sinks.progress import Progress
from placeflow.sources import files, pages

#: Names that mark a clinic or hospital (fixed values).
KEYWORDS = ["병원", "의원"]
#: Rows of the first keyword that make a neighbourhood complete.
LEAST = 40


def published(rows: DataFrame, **options) -> DataFrame:
    """One row for each place: the most complete, ties by file and place in it."""
    scored = [f.name for f in FACILITY] + PATH_KEYS
    return dedup.most_complete(rows, "place_id", ["file_path", "pos"], scored, **options)


def publish(spark: SparkSession, root: str, out: str, title: str = "Places", **options) -> dict:
    """Reads a JSON tree, writes deduplicated Parquet and a card; returns the card's figures."""
    rows = files.json_tree(spark, root)
    best = published(rows, **options).drop("file_path", "pos")
    sinks.parquet(sinks.coerce_times(best), f"{out}/{Settings.read().facilities_file}")
    kept = spark.read.parquet(f"{out}/{Settings.read().facilities_file}")
    figures = {
        **stats.profile(kept, "place_id", "file_district", "file_dong", "category").first().asDict(),
        **stats.date_range(kept, "scraped_at").first().asDict(),
        **dedup.duplicates(rows, "place_id").first().asDict(),
    }
    sinks.card(spark, f"{out}/README.md", title, figures, kept.columns)
    return figures


def medical_records(keys: DataFrame, captured: DataFrame | pages.Store, now: str | None = None) -> DataFrame:
    """Enrichment records for keys (place_id, ...): the section's HTML and its parsed fields, or the text of the failure."""
    found = pages.lookup(keys, captured).withColumn("_r", html.read_enrichment("html"))
    flag = lambda n: F.coalesce(F.col(f"_r.value.{n}"), F.lit(False)).alias(n)
    return found.select(
        "place_id",
        flag("has_medical_info"),
        "_r.value.medical_info_raw",
        "_r.value.medical_info_parsed",
        flag("parsing_success"),
        F.when(F.col("html").isNull(), F.lit(ERRORS["page"])).otherwise(F.coalesce("_r.error", "_r.value.enrichment_error")).alias("enrichment_error"),
        (text.stamp() if now is None else F.lit(now)).alias("enriched_at"),
        F.when(F.col("html").isNotNull(), F.col("place_id")).alias("verified_place_id"),
    )


def enrich(
    places: DataFrame, captured: DataFrame | pages.Store, log: state.Log, part: int = 0, total: int = 1, order: list[str] | None = None, now: str | None = None, every: int = state.EVERY
) -> DataFrame:
    """Slice, then filter by name, then do what is pending, `every` places at a time; returns the log's current state."""
    named = text.has_any("name", KEYWORDS)
    mine = partition.slice_then_filter(files.required(places, "place_id", "name"), order or ["place_id", "name"], part, total, named)
    keys = mine.select(F.coalesce(text.clean_id("place_id"), F.lit(NOT_FOUND)).alias("place_id")).distinct()
    return state.run(keys, log, lambda todo: medical_records(todo, captured, now), every=every)


def enriched(places: DataFrame, records: DataFrame) -> DataFrame:
    """places with their records; without one, both flags are false."""
    return joins.left_defaults(places, records, "place_id", {"has_medical_info": False, "parsing_success": False})


def merge_enriched(spark: SparkSession, places: DataFrame, paths: list[str] | str, out: str) -> DataFrame:
    """The merged checkpoints joined to all places, written as one table; parsed fields are an empty record where there are none."""
    table = enriched(places, merge_checkpoints(spark, paths, "enrichment"))
    parsed = table.schema["medical_info_parsed"].dataType
    empty = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in parsed])
    sinks.parquet(table.withColumn("medical_info_parsed", F.coalesce("medical_info_parsed", empty)), out)
    return spark.read.parquet(out)


def bundles(keys: DataFrame, captured: DataFrame | pages.Store, now: str | None = None) -> DataFrame:
    """Review bundles for keys (place_id, ...): the list's HTML and its reviews, or the text of the failure."""
    found = pages.lookup(keys, captured).withColumn("_r", html.read_review_page("html"))
    at = text.stamp() if now is None else F.lit(now)
    some = F.col("_r.value.reviews")
    there = F.coalesce(F.transform(some, lambda r: r.withField("scraped_at", at)), F.array().cast(BUNDLE["reviews"].dataType))
    return found.select(
        "place_id",
        F.coalesce(F.size(some) > 0, F.lit(False)).alias("has_reviews"),
        F.coalesce(F.size(some), F.lit(0)).alias("review_count"),
        there.alias("reviews"),
        "_r.value.review_html",
        F.when(F.col("html").isNull(), F.lit(ERRORS["page"])).otherwise(F.coalesce("_r.error", "_r.value.scrape_error")).alias("scrape_error"),
        at.alias("scraped_at"),
    )


def reviews(
    places: DataFrame, captured: DataFrame | pages.Store, log: state.Log, part: int = 1, total: int = 1, order: list[str] | None = None, now: str | None = None, every: int = state.EVERY
) -> DataFrame:
    """Filter nulls and names, then slice, then do what is pending, `every` places at a time; returns the flat table of the whole log."""
    known = places.filter("place_id IS NOT NULL AND name IS NOT NULL")
    mine = partition.filter_then_slice(known, order or ["place_id", "name"], part, total, text.has_pattern("name", "|".join(KEYWORDS)))
    keys = mine.select(text.clean_id("place_id").alias("place_id")).distinct()
    return flatten.flat_reviews(state.run(keys, log, lambda todo: bundles(todo, captured, now), every=every), places)


def merge_reviews(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Parts as one table: the first row of each place and review number, in the order of parts and of rows in them."""
    parts = files.parquet_parts(spark, paths, FLAT_REVIEW)
    place = ["part_no", "file_name", "row_no"]
    return dedup.keep_first(parts, ["place_id", "review_index"], place).drop(*place)


def merge_checkpoints(spark: SparkSession, paths: list[str] | str, kind: str = "reviews") -> DataFrame:
    """Workers' checkpoint files as one state; the last part wins."""
    parts = files.checkpoint_map(spark, paths, BUNDLE if kind == "reviews" else ENRICHMENT)
    return state.merged(state.one_run(parts)).drop("file_name", "part")


def merge_checkpoint_files(spark: SparkSession, paths: list[str] | str, out: str, kind: str = "reviews") -> DataFrame:
    """Workers' checkpoint files as one JSON map at out; returns the merged state."""
    whole = merge_checkpoints(spark, paths, kind)
    single.json_map(whole, out)
    return whole


def merge_tree(spark: SparkSession, root: str, out: str, stamp: str) -> list[str]:
    """All rows of a JSON tree as one JSON array and one CSV, named by the stamp; columns in the order of the schema, then of the path."""
    rows = files.json_tree(spark, root).orderBy("file_path", "pos").drop("file_path", "pos")
    if rows.isEmpty():
        return []
    base = f"{out.rstrip('/')}/_merged_all_{stamp}"
    return [single.json_array(rows, f"{base}.json"), single.csv_with_mark(rows, f"{base}.csv", sort_columns=False)]


def rows_by_neighbourhood(spark: SparkSession, root: str, keyword: str = KEYWORDS[0]) -> DataFrame:
    """gu, dong and n: rows after the header of the keyword's CSV files of a tree."""
    rows = files.csv_lines(spark, root, f"{keyword}.csv")
    return rows.select(F.col("file_district").alias("gu"), F.col("file_dong").alias("dong"), "n")


def completed(spark: SparkSession, root: str, document: dict | None, keyword: str = KEYWORDS[0], least: int = LEAST) -> DataFrame:
    """gu and dong of the neighbourhoods that the progress document names, or whose first keyword has enough rows."""
    named = spark.createDataFrame([(d,) for d in (document or {}).get("completed_dongs", [])], "name string")
    split = named.select(F.substring_index("name", "_", 1).alias("gu"), F.expr("substring(name, locate('_', name) + 1)").alias("dong"))
    enough = rows_by_neighbourhood(spark, root, keyword).filter(F.col("n") >= least) if storage.exists(spark, root) else split.limit(0)
    return split.union(enough.select("gu", "dong")).distinct()


def collect(spark: SparkSession, captured: DataFrame, out: str, total: int, max_pages: int | None = 10, first_page_only: bool = False, least: int = LEAST) -> dict:
    """Captured search pages (gu, search_location, search_query, page_number, html) as a tree of files and a progress file.

    Neighbourhoods that are complete (by the progress file, or by the rows of
    their first keyword) are passed over, so running again does only the rest.
    Each search gets its files; one without hits an empty array. Returns the
    progress document.
    """
    progress = Progress(spark, f"{out.rstrip('/')}/progress.json", total)
    done = completed(spark, out, progress.read(), least=least)
    place = [F.col("gu"), F.col("search_location").alias("dong")]
    todo = captured.join(done.select("gu", F.col("dong").alias("search_location")), ["gu", "search_location"], "left_anti")
    hits = pages.search_hits(todo, 1 if first_page_only else max_pages, ("gu", "search_location", "search_query")).checkpoint()
    tried = todo.select(*place, F.col("search_query").alias("keyword")).distinct()
    rows = hits.withColumns(dict(zip(PATH_KEYS, (F.col("gu"), F.col("search_location"), F.col("search_query")), strict=True))).drop("gu")
    trees.tree(rows, out, tried)
    counts = hits.groupBy(*place, F.col("search_query").alias("keyword")).agg(F.count(F.lit(1)).alias("n"))
    now, none = text.stamp(), F.lit(None).cast("string")
    summaries = tried.join(counts, ["gu", "dong", "keyword"], "left").groupBy("gu", "dong").agg(
        F.sort_array(F.collect_list("keyword")).alias("completed_keywords"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_facilities")
    )
    return progress.add(summaries.select("gu", "dong", "completed_keywords", F.array().cast("array<string>").alias("failed_keywords"), "total_facilities", now.alias("start_time"), now.alias("end_time"), none.alias("error")))


def tree_stats(spark: SparkSession, root: str, total: int, least: int = LEAST) -> dict:
    """Files by extension, neighbourhoods whose first keyword has enough rows, and their share."""
    files_ = {r.extension: r.asDict() for r in files.file_counts(spark, root).collect()}
    enough = rows_by_neighbourhood(spark, root).filter(F.col("n") >= least).count()
    return {"files": files_, "complete": enough, "total": total, "percent": 100.0 * enough / total if total else None}


def sample_run(places: DataFrame, captured: DataFrame | pages.Store, out: str, count: int = 5, seed: int = 42, now: str | None = None) -> DataFrame:
    """A small mixed sample of places through the review readers: a JSON file for each place, and a summary as CSV.

    Each place's file holds its bundle without the list's HTML; the summary has a row for each place.
    """
    has = F.coalesce(F.col("reviews").isNotNull() & (F.col("reviews") != ""), F.lit(False)) if "reviews" in places.columns else F.lit(False)
    chosen = sampling.stratified(files.required(places, "place_id", "name"), count, has, "place_id", seed=seed)
    found = bundles(chosen.select(text.clean_id("place_id").alias("place_id")).distinct(), captured, now)
    named = joins.first_match(found, places.select(text.clean_id("place_id").alias("place_id"), "name"), "place_id", "name", ["name"]).checkpoint()
    for row in named.drop("review_html").collect():  # `count` rows
        sinks.write_text(places.sparkSession, f"{out}/{row['place_id']}.json", [sinks.pretty(row.asDict(True))])
    summary = named.select("place_id", "name", "has_reviews", "review_count", "scrape_error")
    single.csv_with_mark(summary, f"{out}/summary.csv", sort_columns=False)
    return summary
