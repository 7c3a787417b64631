"""Lookups of pages by place: plans, bytes read, results."""

import re

import pytest
from pyspark.sql import functions as F

from placeflow.sources import pages

PAGE = 20_000


@pytest.fixture(scope="module")
def captured(spark):
    """Two thousand pages that don't compress, some places twice, some URLs without a place."""
    body = F.concat(*[F.md5(F.concat_ws("-", F.col("id"), F.lit(i))) for i in range(PAGE // 32)])
    return spark.range(2000).select(
        F.when(F.col("id") % 50 == 49, F.concat(F.lit("http://x/about/"), F.col("id").cast("string"))).otherwise(F.concat(F.when(F.col("id") % 2 == 0, "http://b").otherwise("http://a"), F.lit("/place/"), F.format_string("%07d", F.floor(F.col("id") / 2)))).alias("url"),
        body.alias("html"),
    )


@pytest.fixture(scope="module")
def plain(spark, captured, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pages") / "plain")
    captured.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def store(spark, plain, tmp_path_factory):
    return pages.Store.write(plain, str(tmp_path_factory.mktemp("pages") / "store"), files=2, group=400_000)


def bytes_read(spark, action):
    jvm = spark.sparkContext._jvm

    def total():
        return sum(s.getBytesRead() for s in jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())

    before = total()
    action()
    return total() - before


def plan(df):
    df.collect()  # adaptive plans are final then
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_store_gives_what_a_scan_gives(spark, plain, store):
    keys = spark.createDataFrame([("0000003", 1), ("0000500", 2), ("0000500", 3), ("9999999", 4), (None, 5), ("0000024", 6)], "place_id string, n int")
    want = {r.n: r.html for r in pages.lookup(keys, plain).collect()}
    assert {n: h is not None for n, h in want.items()} == {1: True, 2: True, 3: True, 4: False, 5: False, 6: True}
    first = {r.p: r.html for r in plain.groupBy(pages.text.place_id("url").alias("p")).agg(F.min_by("html", "url").alias("html")).collect()}
    assert want[1] == first["0000003"] and want[2] == want[3] == first["0000500"]
    got = pages.lookup(keys, store)
    assert got.columns == ["place_id", "n", "html"] and {r.n: r.html for r in got.collect()} == want
    assert store.read().count() == len(first) - (None in first)


def test_no_html_moves_for_a_store(spark, store):
    keys = spark.range(100, 120).select(F.format_string("%07d", "id").alias("place_id"))
    out = pages.lookup(keys, store)
    assert out.filter("html IS NOT NULL").count() == 20
    shuffles = [line for line in plan(out).split("\n") if re.search(r"(?<!Broadcast)Exchange ", line)]
    assert not shuffles and "BroadcastHashJoin" in plan(out) and "PushedFilters: [IsNotNull(place_id), GreaterThanOrEqual(place_id,0000100), LessThanOrEqual(place_id,0000119)]" in plan(out)


def test_html_of_a_scan_is_read_after_the_keys(spark, plain):
    """What is grouped and joined by URL has no HTML; only pages that were asked for are moved."""
    keys = spark.range(100, 120).select(F.format_string("%07d", "id").alias("place_id"))
    out = pages.lookup(keys, plain)
    assert out.filter("html IS NOT NULL").count() == 20
    text = plan(out)
    scans = re.findall(r"FileScan parquet \[(.*?)\]", text)
    assert {re.sub(r"#\d+", "", s) for s in scans} == {"url", "url,html"}
    assert "BroadcastHashJoin" in text


def test_few_keys_read_few_row_groups(spark, store):
    # vectored reads pass the statistics by
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.hadoop.vectored.io.enabled", "false")
    keys = spark.range(300, 310).select(F.format_string("%07d", "id").alias("place_id"))
    whole = bytes_read(spark, lambda: store.read().agg(F.max("html")).collect())
    some = bytes_read(spark, lambda: pages.lookup(keys, store).write.format("noop").mode("overwrite").save())
    assert whole > 900 * PAGE / 2 and some < whole / 8


def test_many_keys_and_none(spark, store, monkeypatch):
    keys = spark.range(200).select(F.format_string("%07d", "id").alias("place_id"))
    want = {r.place_id: r.html for r in pages.lookup(keys, store).collect()}
    monkeypatch.setattr(pages, "BROADCAST_KEYS", 10)
    assert {r.place_id: r.html for r in pages.lookup(keys, store).collect()} == want and len(want) == 200
    assert pages.lookup(keys.limit(0), store).collect() == []
    assert pages.lookup(keys.select(F.lit(None).cast("string").alias("place_id")).limit(2), store).filter("html IS NULL").count() == 2


def test_places_with_equal_urls(spark, tmp_path):
    rows = spark.createDataFrame([("http://x/place/1", "b"), ("http://x/place/1", "a"), ("http://x/place/1", None), ("http://w/place/2", None)], "url string, html string")
    keys = spark.createDataFrame([("1",), ("2",)], "place_id string")
    for table in (rows, pages.Store.write(rows, str(tmp_path / "s"), files=1)):
        assert {r.place_id: r.html for r in pages.lookup(keys, table).collect()} == {"1": "a", "2": None}
