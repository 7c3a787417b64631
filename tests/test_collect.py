"""Collecting captured pages, task pools, statistics, and the commands for them."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from placeflow import cli
from placeflow.functions import html
from placeflow.operators import dedup, partition, state, stats
from placeflow.plans import pipelines
from placeflow.settings import Settings
from placeflow.sources import files


def item(name):
    return f'<li><span class="TYaxT">{name}</span></li>'


@pytest.fixture
def captured(spark):
    many = "".join(item(f"n{i}") for i in range(45))
    rows = [("g1", "d", "병원", 1, many), ("g1", "d", "의원", 1, item("a") + item("b")), ("g2", "d", "병원", 1, item("a")), ("g2", "d", "병원", 2, item("a") + item("c")), ("g2", "d", "의원", 1, "<p></p>")]
    return spark.createDataFrame(rows, "gu string, search_location string, search_query string, page_number int, html string")


def test_collecting_does_only_the_rest(spark, captured, tmp_path):
    out = str(tmp_path / "out")
    first = pipelines.collect(spark, captured, out, 4, first_page_only=True)
    assert sorted(first["completed_dongs"]) == ["g1_d", "g2_d"] and first["statistics"] == {"total_dongs_completed": 2, "total_facilities": 48, "by_keyword": {"병원": 23, "의원": 23}}
    rows = {(r.file_district, r.file_keyword, r.preview_name) for r in files.json_tree(spark, out, pipelines.FACILITY).collect()}
    assert len(rows) == 48 and ("g2", "병원", "a") in rows and ("g2", "병원", "c") not in rows
    assert json.loads((tmp_path / "out/g2/d/의원.json").read_text()) == []
    assert pipelines.collect(spark, captured, out, 4) == first  # nothing is left to do
    os.remove(tmp_path / "out/progress.json")
    for n in os.listdir(tmp_path / "out/_progress.json.versions"):
        os.remove(tmp_path / "out/_progress.json.versions" / n)
    again = pipelines.collect(spark, captured, out, 4)  # g1 has 40 rows of its first keyword
    assert again["completed_dongs"] == ["g2_d"] and again["statistics"]["total_facilities"] == 2
    assert [r.preview_name for r in files.json_tree(spark, f"{out}", pipelines.FACILITY).filter("file_district = 'g2'").orderBy("pos").collect()] == ["a", "c"]


def test_collect_and_stats_commands(spark, captured, tmp_path, capsys):
    pages, out = str(tmp_path / "pages"), str(tmp_path / "out")
    captured.write.parquet(pages)
    cli.main(["collect", "--pages", pages, "--output", out, "--total", "4", "--min-entries", "3"], spark)
    got = cli.main(["stats", "--data-dir", out, "--total", "4"], spark)
    assert got["complete"] == 1 and got["percent"] == 25.0 and got["files"]["json"]["files"] == 4 and got["files"]["json"]["empty"] == 1 and got["files"]["csv"]["files"] == 3
    assert cli.main(["stats", "--data-dir", out, "--total", "4", "--min-entries", "2"], spark)["complete"] == 2
    assert '"complete": 1' in capsys.readouterr().out


def test_store_and_merged_table_commands(spark, tmp_path):
    captured = spark.createDataFrame([(f"http://x/place/{i}", f"<p>{i}</p>") for i in range(30)], "url string, html string")
    captured.write.parquet(str(tmp_path / "pages"))
    places = spark.createDataFrame([(str(i), f"{i}의원") for i in range(40)], "place_id string, name string")
    places.write.parquet(str(tmp_path / "places"))
    assert cli.main(["store", "--pages", str(tmp_path / "pages"), "--output", str(tmp_path / "store")], spark).count() == 30
    common = ["--places", str(tmp_path / "places"), "--pages", str(tmp_path / "store"), "--export", str(tmp_path), "--total", "2", "--save-freq", "7"]
    for i in range(2):
        out = cli.main(["enrich", *common, "--state", str(tmp_path / f"log{i}"), "--partition", str(i)], spark)
        assert out.count() == 20
    assert files.csv_rows(spark, str(tmp_path / "000_failed.csv")) + files.csv_rows(spark, str(tmp_path / "001_failed.csv")) == 40
    names = f"{tmp_path}/enrichment_progress_partition_*.json"
    table = cli.main(["merge-state", "--files", names, "--output", str(tmp_path / "all.json"), "--places", str(tmp_path / "places"), "--table", str(tmp_path / "table")], spark)
    assert table.count() == 40 and table.filter("medical_info_parsed IS NULL").count() == 0 and len(json.loads((tmp_path / "all.json").read_text())) == 40
    assert {r.enrichment_error for r in table.select("enrichment_error").distinct().collect()} == {pipelines.ERRORS["page"], pipelines.ERRORS["section"]}


def test_every_search_is_a_task_of_its_own(spark):
    """The slow one comes first and holds no other up."""

    def search(gu, dong, word):
        from pyspark import TaskContext

        time.sleep(4 if dong == "slow" else 0.05)
        if word == "bad":
            raise RuntimeError("no page")
        return TaskContext.get().partitionId() * 1000 + TaskContext.get().stageId() * 0

    rows = [("g", f"d{i:02d}", ["a"]) for i in range(20)] + [("g", "slow", ["a", "bad", "b"])]
    tasks = spark.createDataFrame(rows, "gu string, dong string, keywords array<string>").coalesce(1)
    done = {r.dong: r for r in state.run_tasks(tasks, search).collect()}
    assert len(done) == 21 and sorted(r.total_facilities for d, r in done.items() if d != "slow") == [i * 1000 for i in range(1, 21)]
    slow = done["slow"]
    assert (slow.total_facilities, slow.completed_keywords, slow.failed_keywords, slow.error) == (0, ["a", "b"], ["bad"], "no page")
    assert sum(r.end_time < slow.end_time for r in done.values()) >= 18 and all(r.start_time <= r.end_time for r in done.values())
    assert state.run_tasks(tasks.limit(0), search).collect() == []


def test_distinct_counts_multiply_no_row(spark, tmp_path):
    spark.range(1000).select(F.nullif(F.col("id") % 7, F.lit(0)).alias("a"), (F.col("id") % 11).cast("string").alias("b c"), F.lit(None).cast("int").alias("n")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = stats.profile(df, "a", "b c", "n", "missing", "a")
    assert tuple(out.first()) == (1000, 6, 11, 0, None, 6)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in text and "ReadSchema: struct<a:bigint>" in text
    assert tuple(stats.profile(df.limit(0), "a").first()) == (0, 0)


def test_row_numbers_need_no_literal_for_each_partition(spark):
    df = partition.row_index(spark.range(100).repartition(9), ["id"])
    assert [r.row_index for r in df.orderBy("id").collect()] == list(range(100))
    assert len(df._jdf.queryExecution().analyzed().toString()) < 6000


def test_last_writer_of_tied_rows_and_maps(spark):
    rows = [("k", 1, {"a": 1}), ("k", 1, {"a": 2}), ("j", 2, None)]
    for r in (rows, rows[::-1]):
        df = spark.createDataFrame(r, "k string, part int, m map<string, int>")
        got = {x.k: x.m for x in dedup.last_writer(df, ["k"], ["part"]).collect()}
        assert got["j"] is None and got["k"] in ({"a": 1}, {"a": 2})
    df = spark.createDataFrame([("k", 1, None, ["x"]), ("k", 1, "b", None), ("k", 1, "b", ["y"])], "k string, part int, v string, l array<string>")
    assert dedup.last_writer(df, ["k"], ["part"]).columns == ["k", "part", "v", "l"] and dedup.last_writer(df, ["k"], ["part"]).first().l == ["y"]


def test_neighbourhoods_count_once(spark):
    rows = [("g", "d", ["a"], [], 5, "s", "e", None)] * 3 + [("g", "d2", ["a"], [], 1, "s", "e", None)]
    done = spark.createDataFrame(rows, "gu string, dong string, completed_keywords array<string>, failed_keywords array<string>, total_facilities bigint, start_time string, end_time string, error string")
    got = stats.progress(done, 4).first()
    assert (got.total_dongs_completed, got.completion_percentage, got.total_facilities) == (2, 50.0, 16)


def test_a_heading_by_department_is_not_the_list():
    ul = '<ul class="xrrcZ"><li class="zxtJF">내과</li></ul>'
    section = '<div class="DAQTB"><h3 class="fr6Pj">{}</h3>{}</div>'
    assert html.medical_info(section.format("진료과목별 안내", ul)) == {}
    assert html.medical_info(section.format("진료과목별 주차", ul)) == {"parking": ["내과"]}
    assert html.medical_info(section.format("진료과목 안내", ul)) == {"medical_departments": ["내과"]}


def test_settings_come_from_the_environment():
    assert Settings.read({"PLACEFLOW_MAX_PAGES": "3", "PLACEFLOW_TITLE": "x"}) == Settings(max_pages=3, title="x") and Settings.read({}).min_entries == pipelines.LEAST
