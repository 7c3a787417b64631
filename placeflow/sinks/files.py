"""Writers of tables and of small documents. Single files of many rows are in `single`, trees of files in `tree`."""

from __future__ import annotations

import json
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeflow import storage
from placeflow.storage import write_text


def parquet(df: DataFrame, path: str, mode: str = "overwrite", by: list[str] | None = None) -> str:
    w = df.write.mode(mode).option("compression", "snappy")
    (w.partitionBy(*by) if by else w).parquet(path)
    return path


def json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("ignoreNullFields", False).json(path)
    return path


def csv(df: DataFrame, path: str, mode: str = "overwrite", sort_columns: bool = True) -> str:
    """A folder of CSV files with header; arrays and structs as JSON, columns by name."""
    nested = [f.name for f in df.schema if f.dataType.typeName() in ("array", "struct", "map")]
    flat = df.withColumns({n: F.to_json(n) for n in nested})
    cols = sorted(flat.columns) if sort_columns else flat.columns
    flat.select(*cols).write.mode(mode).option("header", True).option("escape", '"').csv(path)
    return path


def hierarchy(df: DataFrame, path: str) -> str:
    """district / dong / keyword folders of Parquet files."""
    return parquet(df, path, by=["file_district", "file_dong", "file_keyword"])


def pretty(value: object) -> str:
    """JSON indented by 2, other scripts unescaped."""
    return json.dumps(value, ensure_ascii=False, indent=2, default=str)


def progress_figures(progress: DataFrame) -> dict:
    """The row of `stats.progress` as the progress file has it: completed neighbourhoods, statistics, times and percentage."""
    r = progress.first().asDict(True)
    figures = {"total_dongs_completed": r["total_dongs_completed"], "total_facilities": r["total_facilities"] or 0, "by_keyword": r["by_keyword"] or {}}
    return {"completed_dongs": r["completed_dongs"], "statistics": figures, "start_time": r["start_time"], "last_updated": r["last_updated"], "completion_percentage": r["completion_percentage"]}


def progress_document(progress: DataFrame, path: str) -> str:
    """The progress file of all summaries, in the place of an old one."""
    return storage.replace(progress.sparkSession, path, [pretty(progress_figures(progress))])


def coerce_times(df: DataFrame) -> DataFrame:
    """Text columns named like times become timestamps if all their values can; else they stay as they are."""
    names = [f.name for f in df.schema if f.dataType.typeName() == "string" and ("time" in f.name.lower() or "date" in f.name.lower() or f.name == "scraped_at")]
    if not names:
        return df
    bad = df.agg(*[F.count_if(F.col(n).isNotNull() & F.try_to_timestamp(F.col(n)).isNull()).alias(n) for n in names]).first()
    return df.withColumns({n: F.try_to_timestamp(F.col(n)) for n in names if not bad[n]})


def task_status(summaries: DataFrame) -> DataFrame:
    """A row for each keyword of run summaries: done, failed, or empty (done without hits)."""
    kind = F.when(F.col("total_facilities") > 0, F.lit("done")).otherwise(F.lit("empty"))
    done = summaries.select("gu", "dong", F.explode("completed_keywords").alias("keyword"), kind.alias("status"))
    failed = summaries.select("gu", "dong", F.explode("failed_keywords").alias("keyword"), F.lit("failed").alias("status"))
    return done.union(failed)


def card(spark: SparkSession, path: str, title: str, stats: dict, columns: list[str]) -> str:
    """A Markdown card from computed figures."""
    lines = [f"# {title}", "", "| figure | value |", "|---|---|"]
    lines += [f"| {k} | {v:,} |" if isinstance(v, int) else f"| {k} | {v} |" for k, v in stats.items()]
    lines += ["", "## Columns", "", *[f"- `{c}`" for c in columns], ""]
    return write_text(spark, path, "\n".join(lines))


class Publisher:
    """Where finished data goes. The library opens no connection; give an object with this method."""

    def publish(self, name: str, files: list[str], private: bool = False) -> str:
        raise NotImplementedError("no publisher is configured")
