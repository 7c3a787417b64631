"""Summary statistics: one pass each, exact distinct counts, ratios without division errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def profile(df: DataFrame, *names: str) -> DataFrame:
    """Rows, and the exact number of distinct values (nulls aside) of each column that exists.

    Each column's values are grouped by themselves, in a scan of that column
    alone, so no row is multiplied by the number of columns; only single rows meet.
    """
    there = [n for n in dict.fromkeys(names) if n in df.columns]
    out = df.agg(F.count(F.lit(1)).alias("n_rows"))
    for n in there:
        one = df.select(F.col(f"`{n}`").alias("v")).filter("v IS NOT NULL").groupBy("v").agg(F.lit(1).alias("_")).agg(F.count(F.lit(1)).alias(f"n_{n}"))
        out = out.join(F.broadcast(one))  # a single row
    return out.select("n_rows", *[F.col(f"`n_{n}`") if n in there else F.lit(None).cast("bigint").alias(f"n_{n}") for n in names])


def date_range(df: DataFrame, column: str) -> DataFrame:
    """First and last day of a time or text column; values that aren't times don't count."""
    t = F.try_to_timestamp(F.col(column)) if dict(df.dtypes)[column] == "string" else F.col(column)
    return df.agg(F.date_format(F.min(t), "yyyy-MM-dd").alias("first_day"), F.date_format(F.max(t), "yyyy-MM-dd").alias("last_day"))


def checkpoint_stats(state: DataFrame) -> DataFrame:
    """processed, with_info, parsed and verified of enrichment state."""
    flag = lambda n: F.count_if(F.coalesce(F.col(n), F.lit(False)))
    verified = F.count_if(F.coalesce(F.col("verified_place_id") != "", F.lit(False)))
    return state.agg(F.count(F.lit(1)).alias("processed"), flag("has_medical_info").alias("with_info"), flag("parsing_success").alias("parsed"), verified.alias("verified"))


def review_stats(state: DataFrame) -> DataFrame:
    """total, with_reviews, total_reviews, and reviews for each place that has some (null without any)."""
    some, n = F.count_if(F.coalesce(F.col("has_reviews"), F.lit(False))), F.sum(F.coalesce("review_count", F.lit(0))).cast("bigint")
    return state.agg(F.count(F.lit(1)).alias("total"), some.alias("with_reviews"), n.alias("total_reviews"), F.try_divide(n, some).alias("per_place"))


def merge_stats(reviews: DataFrame) -> DataFrame:
    """Rows, places, and rows without a review (null text; an empty one is a review)."""
    return reviews.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("place_id").alias("n_places"), F.count_if(F.col("review_text").isNull()).alias("without_reviews"))


def presence(df: DataFrame, names: list[str]) -> DataFrame:
    """Columns and how many rows have a value in them, most first; columns without any are left out."""
    counts = df.agg(F.array(*[F.struct(F.lit(n).alias("field"), F.count(n).alias("n")) for n in names]).alias("_c"))
    return counts.select(F.inline("_c")).filter("n > 0").orderBy(F.desc("n"), "field")


def field_presence(df: DataFrame, struct: str) -> DataFrame:
    """As presence, for the fields of a struct column (empty arrays and texts aren't values)."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema[struct].dataType}
    there = lambda n: F.size(F.col(f"{struct}.{n}")) > 0 if kinds[n] == "array" else F.col(f"{struct}.{n}").isNotNull()
    return presence(df.select(*[F.when(there(n), F.lit(1)).alias(n) for n in kinds]), list(kinds))


def credit(summaries: DataFrame, mode: str = "equal") -> DataFrame:
    """Hits credited to keywords: an equal floor share of each run's total, or ('actual') the counted hits in `hits`."""
    if mode == "actual":
        return summaries.groupBy("keyword").agg(F.sum("hits").alias("credit"))
    words = F.col("completed_keywords")
    part = F.expr("total_facilities div greatest(size(completed_keywords), 1)")
    return summaries.select(F.explode(words).alias("keyword"), part.alias("_p")).groupBy("keyword").agg(F.sum("_p").alias("credit"))


def progress(summaries: DataFrame, total: int, complete_on_error: bool = True) -> DataFrame:
    """The progress document as a row: completed neighbourhoods, totals, credit by keyword, percentage.

    A neighbourhood that was run several times is completed once; the hits of all its runs count.
    """
    done = summaries if complete_on_error else summaries.filter("error IS NULL")
    by = F.map_from_entries(F.collect_list(F.struct("keyword", "credit")))
    head = done.agg(
        F.array_sort(F.collect_set(F.concat_ws("_", "gu", "dong"))).alias("completed_dongs"),
        F.count_distinct(F.concat_ws("_", "gu", "dong")).alias("total_dongs_completed"),
        F.sum("total_facilities").alias("total_facilities"),
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("last_updated"),
    )
    # both sides are single rows
    out = head.join(F.broadcast(credit(done).agg(by.alias("by_keyword"))))
    return out.withColumn("completion_percentage", F.try_divide(100.0 * F.col("total_dongs_completed"), F.lit(total)))


def over_threshold(rows: DataFrame, keys: list[str], least: int = 40) -> DataFrame:
    """Keys with at least so many rows."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def completion(rows: DataFrame, keys: list[str], all_keys: DataFrame, least: int = 40) -> DataFrame:
    """How many of all keys have enough rows, and the percentage."""
    marked = all_keys.select(*keys).distinct().join(over_threshold(rows, keys, least).withColumn("_d", F.lit(1)), keys, "left")
    return marked.agg(F.count("_d").alias("done"), F.count(F.lit(1)).alias("total"), F.try_divide(100.0 * F.count("_d"), F.count(F.lit(1))).alias("percent"))


def breakdown(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of each category and their percentage of all."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = groups.agg(F.sum("n").alias("_t"))  # a single row
    return groups.join(F.broadcast(total)).select(*keys, "n", (100.0 * F.col("n") / F.col("_t")).alias("percent"))


def rating(df: DataFrame, value: Column | str, *keys: str) -> DataFrame:
    v = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*keys).agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.min(v).alias("least"), F.max(v).alias("most"))
