"""Logs, resumable runs and progress files under crashes and beside other writers."""

import json
import os
import subprocess
import sys
import threading

import pytest
from pyspark.sql import functions as F

from placeflow import storage
from placeflow.operators import state
from placeflow.schemas import ENRICHMENT, SUMMARY
from placeflow.sinks.progress import Progress


def batch(spark, at, *keys):
    return spark.createDataFrame([(k, at) for k in keys], "place_id string, enriched_at string")


def records(df):
    return sorted((r.place_id, r.enriched_at) for r in df.collect())


@pytest.fixture
def log(spark, tmp_path):
    return state.Log(spark, str(tmp_path / "log"), ENRICHMENT)


def crashing(step, monkeypatch, spark):
    """Lets the step-th call into storage fail, before it does anything."""
    calls = []
    for name in ("put", "delete", "read_text", "write_text", "replace", "names"):
        plain = getattr(storage, name)

        def wrapped(*a, plain=plain, **k):
            calls.append(name)
            if len(calls) == step:
                raise OSError("lost")
            return plain(*a, **k)

        monkeypatch.setattr(storage, name, wrapped)
    return calls


def test_a_crash_at_any_step_of_a_compaction_loses_nothing(spark, tmp_path, monkeypatch):
    lost = 0
    for step in range(1, 9):
        log = state.Log(spark, str(tmp_path / f"log{step}"), ENRICHMENT)
        log.append(batch(spark, "a", "1", "2"))
        log.append(batch(spark, "b", "2", "3"))
        want = [("1", "a"), ("2", "b"), ("3", "b")]
        with monkeypatch.context() as m:
            calls = crashing(step, m, spark)
            try:
                log.compact()
            except OSError:
                lost += 1
            assert len(calls) <= 8
        assert records(log.current()) == want
        log.append(batch(spark, "c", "2"))
        log.compact()
        assert records(log.current()) == [("1", "a"), ("2", "c"), ("3", "b")] and log.all().count() == 3
    assert lost >= 4


def test_readers_and_appends_beside_a_compaction(spark, log, monkeypatch):
    """A reader at every step of a compaction, and an append between its reading and its snapshot."""
    log.append(batch(spark, "a", "1", "2"))
    log.append(batch(spark, "b", "2"))
    pinned, before = log.all(), log.snapshots.last()[0]
    plain, seen = storage.put, []

    def put(*a):
        seen.append(records(log.current()))
        if len(seen) == 1:
            log.append(batch(spark, "c", "1"))  # takes the number; its own put is the second call
        return plain(*a)

    monkeypatch.setattr(storage, "put", put)
    log.compact()
    monkeypatch.undo()
    assert len(seen) == 3 and records(log.current()) == [("1", "c"), ("2", "b")] and log.all().count() == 3
    assert seen == [[("1", "a"), ("2", "b")]] * 2 + [[("1", "c"), ("2", "b")]]
    assert records(pinned) == [("1", "a"), ("2", "a"), ("2", "b")] == records(log.all(before))
    log.vacuum(older_than=0)
    assert log.snapshots.numbers() == [log.snapshots.last()[0]] and records(log.current()) == [("1", "c"), ("2", "b")]
    assert len(storage.names(spark, f"{log.path}/data")) == 2


def test_two_appends_at_once(spark, log):
    found = [None] * 4

    def write(i):
        found[i] = log.append(batch(spark, f"t{i}", str(i), "x"), token="same" if i < 2 else None)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(found) == [False, True, True, True]  # one token, one batch
    assert log.all().count() == 6 and log.snapshots.last()[0] == 3 and len(log.current().collect()) == 4
    assert len(storage.names(spark, f"{log.path}/data")) == 3


def test_vacuum_spares_young_folders_and_kept_snapshots(spark, log):
    for at in "abc":
        log.append(batch(spark, at, "1"))
    batch(spark, "z", "9").write.parquet(f"{log.path}/data/unnamed")
    log.compact()
    log.vacuum(keep=2)
    assert "unnamed" in storage.names(spark, f"{log.path}/data") and len(log.snapshots.numbers()) == 2
    assert records(log.all(log.snapshots.numbers()[0])) == [("1", "a"), ("1", "b"), ("1", "c")]
    log.vacuum(older_than=0)
    assert len(storage.names(spark, f"{log.path}/data")) == 1 and records(log.current()) == [("1", "c")]


def test_empty_logs(spark, log):
    assert log.current().count() == 0
    log.compact()
    log.vacuum()
    assert log.append(batch(spark, "a").limit(0)) and log.current().count() == 0
    assert records(state.run(batch(spark, "a").limit(0).select("place_id"), log, lambda b: b)) == []


def test_a_failing_batch_costs_itself_only(spark, log):
    items = spark.range(95).select(F.format_string("%03d", "id").alias("place_id"))
    done = []

    def work(broken):
        def do(df):
            n = df.count()
            if len(done) == broken:
                raise ValueError("broken batch")
            done.append(n)
            return df.withColumn("enriched_at", F.lit(str(len(done))))

        return do

    with pytest.raises(Exception, match="broken batch"):
        state.run(items, log, work(3), every=10)
    assert len(done) == 3 and log.current().count() == sum(done) and max(done) <= 10
    assert not storage.names(spark, f"{log.path}/work")
    out = state.run(items, log, work(None), every=10)
    assert out.count() == 95 == sum(done) == log.all().count() and max(done) <= 10
    before = len(done)
    assert state.run(items, log, work(None), every=10).count() == 95 and len(done) == before


KILLED = """
import os, signal, sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
from placeflow.operators import state
from placeflow.schemas import ENRICHMENT
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {folder!r}).getOrCreate()
items = spark.range(60).select(F.format_string("%03d", "id").alias("place_id"))
done = []
def work(df):
    done.append(df.count())
    if len(done) == 4:
        os.kill(os.getpid(), signal.SIGKILL)
    return df.withColumn("enriched_at", F.lit("first"))
state.run(items, state.Log(spark, {log!r}, ENRICHMENT), work, every=10)
"""


def test_a_killed_run_is_taken_up_where_it_was(spark, log, tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    child = subprocess.run([sys.executable, "-c", KILLED.format(root=root, folder=str(tmp_path / "cp"), log=log.path)], capture_output=True, timeout=180)
    assert child.returncode == -9, child.stderr[-2000:]
    first = {r.place_id for r in log.current().collect()}
    assert len(first) >= 20
    tried = []
    items = spark.range(60).select(F.format_string("%03d", "id").alias("place_id"))

    def work(df):
        tried.extend(r.place_id for r in df.collect())
        return df.withColumn("enriched_at", F.lit("second"))

    out = {r.place_id: r.enriched_at for r in state.run(items, log, work, every=10).collect()}
    assert len(out) == 60 and set(tried) == set(out) - first and {k for k, v in out.items() if v == "first"} == first


def summaries(spark, *rows):
    return spark.createDataFrame([(g, d, words, [], n, at, at, None) for g, d, words, n, at in rows], SUMMARY)


def test_progress_of_workers_at_once(spark, tmp_path):
    path = str(tmp_path / "p" / "progress.json")
    work = [summaries(spark, ("g", f"d{i}", ["a", "b"], 10, f"t{i}"), ("g", "d0", ["a"], 1, "t0")) for i in range(4)]
    threads = [threading.Thread(target=lambda s=s: Progress(spark, path, 8).add(s)) for s in work]
    [t.start() for t in threads]
    [t.join() for t in threads]
    got = Progress(spark, path, 8).read()
    assert sorted(got["completed_dongs"]) == ["g_d0", "g_d1", "g_d2", "g_d3"] and got["completion_percentage"] == 50.0
    assert got["statistics"] == {"total_dongs_completed": 4, "total_facilities": 44, "by_keyword": {"a": 24, "b": 20}}
    assert (got["start_time"], got["last_updated"]) == ("t0", "t3")
    assert json.loads(open(path).read()) == got and not [n for n in os.listdir(tmp_path / "p") if n.startswith(".")]


def test_a_crash_at_any_step_of_a_progress_update(spark, tmp_path, monkeypatch):
    """The file is the old or the new one, whole; the summaries count once after the worker tries again only if they were lost."""
    for step in range(1, 9):
        path = str(tmp_path / f"p{step}.json")
        Progress(spark, path, 4).add(summaries(spark, ("g", "d1", ["a"], 5, "t")))
        one = open(path).read()
        with monkeypatch.context() as m:
            crashing(step, m, spark)
            try:
                Progress(spark, path, 4).add(summaries(spark, ("g", "d2", ["a"], 7, "u")))
            except OSError:
                pass
        now = json.loads(open(path).read())
        assert now["statistics"]["total_facilities"] in (5, 12) and (now == json.loads(one)) == (now["statistics"]["total_facilities"] == 5)
        mended = Progress(spark, path, 4).read()
        assert json.loads(open(path).read()) == mended and mended["statistics"]["total_facilities"] in (5, 12)


def test_progress_takes_up_an_old_file(spark, tmp_path):
    path = str(tmp_path / "progress.json")
    old = {"completed_dongs": ["g_d1"], "statistics": {"total_dongs_completed": 1, "total_facilities": 3, "by_keyword": {"a": 3}}, "start_time": "s"}
    storage.replace(spark, path, [json.dumps(old)])
    got = Progress(spark, path, 4).add(summaries(spark, ("g", "d1", ["a"], 2, "t")))
    assert got["completed_dongs"] == ["g_d1"] and got["statistics"]["total_facilities"] == 5 and got["completion_percentage"] == 25.0


def test_files_are_put_once_and_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "x" / "a.json")
    storage.write_text(spark, path, ["old"])  # leaves a checksum file beside it
    storage.replace(spark, path, ["new ", "text"])
    assert storage.read_text(spark, path) == "new text" and storage.names(spark, str(tmp_path / "x")) == ["a.json"]
    assert not storage.put(spark, path, ["other"]) and storage.read_text(spark, path) == "new text"
    won = []
    threads = [threading.Thread(target=lambda i=i: won.append(i) if storage.put(spark, str(tmp_path / "n.json"), [str(i)]) else None) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and storage.read_text(spark, str(tmp_path / "n.json")) == str(won[0])
