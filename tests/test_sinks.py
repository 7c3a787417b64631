"""Trees of files and single files, written by the tasks."""

import json
import os

import pytest
from pyspark.sql import functions as F

from placeflow import arrowfs, storage
from placeflow.sinks import single, tree
from placeflow.sources import files


def found(root):
    return {os.path.relpath(os.path.join(d, n), root): open(os.path.join(d, n), "rb").read() for d, _, names in os.walk(root) for n in names if not n.endswith(".crc")}


@pytest.fixture
def rows(spark):
    """Keywords of very different sizes, in no order."""
    return spark.range(3000).select(
        F.concat(F.lit("g "), (F.col("id") % 3).cast("string")).alias("file_district"), F.lit("d+1%").alias("file_dong"),
        F.when(F.col("id") < 2000, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 17).cast("string"))).alias("file_keyword"),
        F.col("id").cast("string").alias("place_id"), F.when(F.col("id") % 5 > 0, F.concat(F.lit('a,"é'), F.col("id").cast("string"), F.lit("\n"))).alias("name"), F.array(F.lit("x"), F.lit("y")).alias("tags"),
    ).repartition(7).checkpoint()


def test_files_hold_their_rows_in_order(spark, rows, tmp_path):
    status = spark.createDataFrame([("g 0", "d+1%", "hot"), ("g 0", "d+1%", "none"), ("g 0", "d+1%", "none"), ("new", "d", "é")], "gu string, dong string, keyword string")
    root = str(tmp_path / "out")
    tree.tree(rows, root, status)
    got, want = found(root), {}
    for r in rows.collect():  # its order is that of the partitions
        want.setdefault(f"{r.file_district}/{r.file_dong}/{r.file_keyword}", []).append(r)
    assert set(got) == {f"{k}.{kind}" for k in want for kind in ("json", "csv")} | {"g 0/d+1%/none.json", "new/d/é.json"}
    assert got["new/d/é.json"] == got["g 0/d+1%/none.json"] == b"[]"
    for k, some in want.items():
        assert [x["place_id"] for x in json.loads(got[f"{k}.json"])] == [r.place_id for r in some]
        assert all(x.get("name") == r.name and x["tags"] == ["x", "y"] and "file_dong" not in x for x, r in zip(json.loads(got[f"{k}.json"]), some, strict=True))
        assert got[f"{k}.csv"].startswith(b"\xef\xbb\xbfname,place_id,tags\r\n")
    assert len(want["g 0/d+1%/hot"]) > 600 and files.csv_rows(spark, f"{root}/g 0/d+1%/hot.csv") == len(want["g 0/d+1%/hot"])
    tree.tree(rows.filter("file_keyword = 'hot'").limit(1), root)  # over what is there
    assert len(found(root)) == len(got) and sum(len(v) for v in found(root).values()) < sum(map(len, got.values()))


def test_a_failing_job_leaves_nothing_of_its_tasks(spark, rows, tmp_path):
    root = str(tmp_path / "out")
    tree.tree(rows.filter("file_keyword = 'k1'"), root)
    before = found(root)
    bad = rows.withColumn("name", F.when(F.col("place_id") == "2999", F.raise_error(F.lit("lost"))).otherwise(F.col("name")))
    with pytest.raises(Exception, match="lost"):
        tree.tree(bad.filter("file_keyword <> 'k1'").coalesce(1), root)
    assert found(root) == before and not [n for n in os.listdir(root) if n.startswith("_")]


def test_a_task_that_fails_between_files_moves_none(tmp_path):
    import pyarrow as pa

    def batches():
        yield pa.RecordBatch.from_pydict({"file_district": ["g", "g"], "file_dong": ["d", "d"], "file_keyword": ["a", "b"], "j": ["{}", "{}"], "c": ["1", "2"]})
        raise OSError("killed")

    root = str(tmp_path / "out")
    writer = tree._Writer({"path": root, "work": f"{root}/_writing-x", "head": "h"})
    with pytest.raises(OSError):
        writer.write(batches())
    assert set(os.listdir(root)) == {"_writing-x"}
    writer.abort([None])
    assert os.listdir(root) == []


def test_an_empty_tree(spark, rows, tmp_path):
    tree.tree(rows.limit(0), str(tmp_path / "out"))
    assert found(str(tmp_path / "out")) == {}


ODD = 'b string, a int, `c d` array<string>, t timestamp, s struct<x: string, y: date>, m map<string, int>'


def odd(spark, n):
    made = spark.range(n).select(
        F.when(F.col("id") % 7 > 0, F.concat(F.lit('가,"'), F.col("id").cast("string"), F.lit("\r\n"))).alias("b"), F.col("id").cast("int").alias("a"), F.array(F.lit("x"), F.lit(None)).alias("c d"),
        F.timestamp_micros(F.lit(1_700_000_000_123_400) + F.col("id")).alias("t"), F.struct(F.lit("\t").alias("x"), F.lit("2026-01-02").cast("date").alias("y")).alias("s"), F.create_map(F.lit("k"), F.col("id").cast("int")).alias("m"),
    )
    assert made.schema.simpleString().count(":") >= 6
    return made


@pytest.mark.parametrize(("n", "parts"), [(0, 3), (1, 4), (1000, 1), (1000, 9)])
def test_single_files_equal_those_written_in_one_stream(spark, tmp_path, monkeypatch, n, parts):
    df = odd(spark, n).repartition(parts).checkpoint()
    keyed = df.withColumn("place_id", F.concat(F.lit('"k'), F.col("a").cast("string")))

    def write(folder):
        for name, f in (("a.json", single.json_array), ("b.csv", single.csv_with_mark), ("m.json", single.json_map)):
            os.makedirs(tmp_path / folder, exist_ok=True)
            (tmp_path / folder / name).write_text("an old file")
            out = f(keyed if name == "m.json" else df, str(tmp_path / folder / name))
            assert out == (None if n == 0 and name == "b.csv" else str(tmp_path / folder / name))
        return found(str(tmp_path / folder))

    got = write("tasks")
    monkeypatch.setattr(arrowfs, "reachable", lambda path: False)
    assert got == write("stream") and not [k for k in got if k.startswith(".")]
    table = [r.asDict(True) for r in df.collect()]
    assert got["a.json"].decode() == json.dumps(table, ensure_ascii=False, indent=2, default=str)
    records = {r.pop("place_id"): r for r in sorted((r.asDict(True) for r in keyed.collect()), key=lambda r: r["place_id"])}
    assert got["m.json"].decode() == json.dumps(records, ensure_ascii=False, indent=2, default=str)
    if n:
        assert files.csv_rows(spark, str(tmp_path / "tasks/b.csv")) == n


def test_a_failing_row_leaves_the_old_file(spark, tmp_path):
    storage.replace(spark, str(tmp_path / "x.json"), ["old"])
    with pytest.raises(Exception, match="lost"):
        single.json_array(spark.range(50).select(F.when(F.col("id") == 49, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("i")), str(tmp_path / "x.json"))
    assert os.listdir(tmp_path) == ["x.json"] and (tmp_path / "x.json").read_text() == "old"


def test_parts_are_joined_where_the_file_system_can(spark, tmp_path, monkeypatch):
    """Without a folder that all mount, tasks write parts; a file system that can't join them gets the stream."""
    monkeypatch.setattr(single, "_in_place", None)
    joined = []
    monkeypatch.setattr(single.arrowfs.Store, "local", property(lambda self: False, lambda self, v: None), raising=False)
    plain = single._joined
    monkeypatch.setattr(single, "_joined", lambda *a: joined.append(a[4]) or plain(*a))
    df = odd(spark, 500).repartition(5).checkpoint()
    single.json_array(df, str(tmp_path / "x.json"))
    assert joined == [[0, 1, 2, 3, 4]] and json.loads((tmp_path / "x.json").read_text())[0]["a"] == df.first().a
    assert os.listdir(tmp_path) == ["x.json"]
