"""Command line: python -m placeflow.cli COMMAND ... (store, collect, stats, progress, publish, enrich, reviews, merge, merge-state, merge-tree, sample)."""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeflow import session
from placeflow.operators import sampling, state, stats
from placeflow.plans import pipelines
from placeflow.schemas import BUNDLE, ENRICHMENT, SUMMARY
from placeflow.settings import Settings
from placeflow.sinks import files as sinks
from placeflow.sinks import single
from placeflow.sources import files, pages


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="placeflow", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    now = Settings.read()

    def command(name: str, *flags: str, **options: object) -> argparse.ArgumentParser:
        c = sub.add_parser(name)
        for f in flags:
            c.add_argument(f, required=True)
        for k, v in options.items():
            kind = {"action": "store_true"} if isinstance(v, bool) else {"default": v, "type": type(v)}
            c.add_argument(f"--{k.replace('_', '-')}", **kind)
        return c

    command("publish", "--data-dir", "--output", title=now.title, repo_name="", private=False, no_upload=False)
    command("store", "--pages", "--output")
    command("collect", "--pages", "--output", total=1, max_pages=now.max_pages, first_page_only=False, min_entries=now.min_entries)
    command("stats", "--data-dir", total=1, min_entries=now.min_entries)
    command("enrich", "--places", "--pages", "--state", partition=0, total=1, export="", save_freq=now.save_freq)
    command("merge-state", "--files", "--output", kind="enrichment", places="", table="")
    command("merge-tree", "--data-dir", "--output")
    command("reviews", "--places", "--pages", "--state", "--output", partition_x=1, partition_y=1, save_freq=now.save_freq)
    command("merge", "--data-dir", "--output", partitions=1, stem="reviews_p", suffix=".parquet")
    command("progress", "--summaries", total=1, output="")
    command("sample", "--places", num=now.sample_count, seed=now.sample_seed, pages="", output="")
    return p


def places(spark, path: str) -> DataFrame:
    """The first of path as Parquet or CSV that can be read."""
    return files.required(files.first_readable(spark, [("csv" if path.endswith(".csv") else "parquet", path)]), "place_id", "name")


def captured(spark, path: str) -> DataFrame | pages.Store:
    """A store of pages, or any table of them."""
    table = spark.read.parquet(path)
    return pages.Store(spark, path) if table.columns == ["place_id", "url", "html"] else table


def main(argv: list[str] | None = None, spark=None, publisher: sinks.Publisher | None = None) -> DataFrame | dict | list | None:
    a = parser().parse_args(argv)
    spark = spark or session.build()
    if a.command == "publish":
        out = pipelines.publish(spark, a.data_dir, a.output, a.title)
        print(out)
        if a.repo_name and not a.no_upload:
            (publisher or sinks.Publisher()).publish(a.repo_name, [f"{a.output}/{Settings.read().facilities_file}", f"{a.output}/README.md"], a.private)
        return out
    if a.command == "store":
        return pages.Store.write(spark.read.parquet(a.pages), a.output).read()
    if a.command == "collect":
        out = pipelines.collect(spark, spark.read.parquet(a.pages), a.output, a.total, a.max_pages, a.first_page_only, a.min_entries)
        print(sinks.pretty(out))
        return out
    if a.command == "stats":
        out = pipelines.tree_stats(spark, a.data_dir, a.total, a.min_entries)
        print(sinks.pretty(out))
        return out
    if a.command == "enrich":
        log = state.Log(spark, a.state, ENRICHMENT, error="enrichment_error")
        out = pipelines.enrich(places(spark, a.places), captured(spark, a.pages), log, a.partition, a.total, every=a.save_freq)
        stats.checkpoint_stats(out).show()
        if a.export:
            name = files.part_names("enrichment_progress_partition_", a.total, ".json", 3)
            single.json_map(out, f"{a.export}/{name[0].replace('001_of', f'{a.partition:03d}_of')}")
            failed = out.filter("enrichment_error IS NOT NULL").select("place_id", "enrichment_error", "enriched_at").orderBy("place_id")
            single.csv_with_mark(failed, f"{a.export}/{a.partition:03d}_{Settings.read().failed_file}", sort_columns=False)
        return out
    if a.command == "merge-state":
        out = pipelines.merge_checkpoint_files(spark, a.files, a.output, a.kind)
        (stats.checkpoint_stats if a.kind == "enrichment" else stats.review_stats)(out).show()
        if a.kind == "enrichment" and a.places and a.table:
            return pipelines.merge_enriched(spark, places(spark, a.places), a.files, a.table)
        return out
    if a.command == "merge-tree":
        return pipelines.merge_tree(spark, a.data_dir, a.output, f"{datetime.now():%Y%m%d_%H%M%S}")
    if a.command == "reviews":
        log = state.Log(spark, a.state, BUNDLE, error="scrape_error")
        out = pipelines.reviews(places(spark, a.places), captured(spark, a.pages), log, a.partition_x, a.partition_y, every=a.save_freq)
        name = files.part_names("reviews_p", a.partition_y, ".parquet")[a.partition_x - 1]
        sinks.parquet(out, f"{a.output}/{name}")
        stats.merge_stats(out).show()
        return out
    if a.command == "merge":
        out = pipelines.merge_reviews(spark, [f"{a.data_dir}/{n}" for n in files.part_names(a.stem, a.partitions, a.suffix)])
        sinks.parquet(out, a.output)
        stats.merge_stats(out).show()
        return out
    if a.command == "progress":
        out = stats.progress(spark.read.schema(SUMMARY).json(a.summaries), a.total)
        if a.output:
            sinks.progress_document(out, a.output)
        out.show(truncate=False)
        return out
    rows = places(spark, a.places)
    if a.pages and a.output:
        out = pipelines.sample_run(rows, captured(spark, a.pages), a.output, a.num, a.seed)
        out.show(truncate=False)
        return out
    has = F.coalesce(F.col("reviews").isNotNull() & (F.col("reviews") != ""), F.lit(False)) if "reviews" in rows.columns else F.lit(False)
    out = sampling.stratified(rows, a.num, has, "place_id", seed=a.seed)
    out.show(truncate=False)
    return out


if __name__ == "__main__":
    main()
