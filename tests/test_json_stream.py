"""JSON files read piece by piece: equal to reading them at once, in bounded memory."""

import io
import json
import random
import subprocess
import sys

import pytest

from placeflow import arrowfs
from placeflow.schemas import BUNDLE, ENRICHMENT
from placeflow.sources import files, json_stream


def streamed(text, array, chunk, monkeypatch):
    monkeypatch.setattr(json_stream, "CHUNK", chunk)
    data = text if isinstance(text, bytes) else text.encode()
    return [(k, v, t) for k, v, t in json_stream.elements(io.BytesIO(data), array)]


def anything(r, depth=3):
    kind = r.randrange(8 if depth else 5)
    if kind == 5 or kind == 6:
        return {r.choice(["a", "}", '"', "\\", "é日\U0001f600", "k" * 30]) + str(i): anything(r, depth - 1) for i in range(r.randrange(4))}
    if kind == 7:
        return [anything(r, depth - 1) for _ in range(r.randrange(4))]
    return [r.randrange(-(10**12), 10**12), r.random() * 1e9, r.choice([True, False, None]), r.choice(["", "x}", "{", "]\\", 'q"\\"', "é日\U0001f600 \n\t" * r.randrange(9), "\\u00e9"]), 0][kind]


def test_elements_are_those_of_the_whole_text(monkeypatch):
    r = random.Random(3)
    for i in range(300):
        rows = [anything(r) for _ in range(r.randrange(6))]
        whole = rows if i % 2 else {f"{r.choice(['1', '}', chr(34)])}{j}": v for j, v in enumerate(rows)}
        text = json.dumps(whole, ensure_ascii=bool(i % 3), indent=r.choice([None, 2, 4]), separators=r.choice([None, (",", ":")]) if i % 4 else None)
        text = r.choice(["", " \n", "\ufeff"]) + text + r.choice(["", "\n", " \t"])
        for chunk in (1, 2, 3, 7, 64, 1 << 20):
            got = streamed(text, bool(i % 2), chunk, monkeypatch)
            assert [(k, v) for k, v, _ in got] == ([(None, v) for v in rows] if i % 2 else list(whole.items())), (text, chunk)
            assert [json.loads(t) for *_, t in got] == [v for _, v, _ in got]


@pytest.mark.parametrize("text", ["", " ", "{oops", "[{}", "[{},]", "[{} {}]", "[,{}]", "[{}]x", '[{"a": 1]', '{"a": {}}', "[1", "[tru]", '["a', b"[\xff]", "nul", '[{"a": "b}]', "[{}][]"])
def test_what_is_not_one_array_is_an_error(text, monkeypatch):
    for chunk in (1, 5, 1 << 20):
        with pytest.raises(ValueError):
            streamed(text, True, chunk, monkeypatch)


@pytest.mark.parametrize("text", ["[]", '{"a" {}}', '{"a": {},}', "{a: {}}", '{"a": {}', '{"a": }', '{"a": {}}}', '{"a": {} "b": {}}', "{1: 2}"])
def test_what_is_not_one_object_is_an_error(text, monkeypatch):
    for chunk in (1, 5, 1 << 20):
        with pytest.raises(ValueError):
            streamed(text, False, chunk, monkeypatch)


def test_a_malformed_file_is_known_without_reading_it_whole(monkeypatch):
    """An error in the middle isn't taken for a text that ends too early."""
    monkeypatch.setattr(json_stream, "CHUNK", 1000)
    file = io.BytesIO(b'[{"a": 1}, {"b" 2}, ' + b'{"c": "xxxxxxxx"}, ' * 100_000)
    with pytest.raises(ValueError):
        list(json_stream.elements(file, True))
    assert file.tell() < 10_000


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else (text if isinstance(text, str) else json.dumps(text, ensure_ascii=False)).encode())


def test_trees_by_pieces_and_at_once(spark, tmp_path, monkeypatch):
    """Both readers give the same rows; names with blanks, signs and other scripts; broken files give none."""
    root = tmp_path / "t ree"
    put(root / "가 구/c+d%41/병 원.json", [{"place_id": "1", "name": "a}\"{", "page_number": 2}, {}, {"unknown": 1, "name": None}])
    put(root / "g/d/deep/er/k.json", [{"place_id": str(i)} for i in range(50)])
    for name, text in {"a": "{oops", "b": "[]", "c": '[{"place_id": "x"}', "d": "", "e": '[{"place_id": "y"}, 3]', "f": '{"place_id": "z"}', "h": b'[{"place_id": "\xff"}]', "i": '[{"place_id": "w"}] x'}.items():
        put(root / f"bad/d/{name}.json", text)
    put(root / "g/progress.json", [{"place_id": "p"}])
    put(root / "top.json", [{"place_id": "t"}])
    monkeypatch.setattr(json_stream, "BATCH", 40)
    rows = files.json_tree(spark, str(root))
    got = sorted(map(str, rows.select("file_district", "file_dong", "file_keyword", "pos", "place_id", "name", "page_number").collect()))
    assert len(got) == 53 and {(r.file_district, r.file_dong, r.file_keyword) for r in rows.collect()} == {("가 구", "c+d%41", "병 원"), ("g", "d", "k")}
    monkeypatch.setattr(arrowfs, "reachable", lambda path: False)
    for name in "hi":  # the reader of whole files takes bytes that aren't UTF-8, and text after the end
        put(root / f"bad/d/{name}.json", "{}")
    at_once = files.json_tree(spark, str(root)).select("file_district", "file_dong", "file_keyword", "pos", "place_id", "name", "page_number")
    assert sorted(map(str, at_once.collect())) == got


def test_maps_by_pieces_and_at_once(spark, tmp_path, monkeypatch):
    ok = {"has_medical_info": True, "medical_info_raw": '<p class="x">{}</p>\n' * 50}
    put(tmp_path / "s_p1_of_2.json", {"1": ok, 'q"}2': ok | {"enriched_at": "é"}, "3": {}})
    put(tmp_path / "s_p2_of_2.json", '{"1": {"enriched_at": "b"}')
    paths = [str(tmp_path / f"s_p{i}_of_2.json") for i in (1, 2, 3)]
    got = sorted(map(str, files.checkpoint_map(spark, paths).collect()))
    assert len(got) == 3
    monkeypatch.setattr(arrowfs, "reachable", lambda path: False)
    assert sorted(map(str, files.checkpoint_map(spark, paths).collect())) == got


def test_reports_of_files_at_any_depth(spark, tmp_path):
    for name, text in {"a/b/c.json": [{}, {}], "a/b/c/d/e.json": [], "top.json": [1, "x"], "a/x.json": "{oops", "a/b/progress.json": [{}], "a/b/c.csv": "x\ny", "a/LICENSE": "z"}.items():
        put(tmp_path / name, text)
    report = {r.file_path.rpartition("/")[2]: (r.extension, r.n_rows) for r in files.file_report(spark, str(tmp_path)).collect()}
    assert report == {"c.json": ("json", 2), "e.json": ("json", 0), "top.json": ("json", 2), "x.json": ("json", None), "c.csv": ("csv", None), "LICENSE": ("", None)}
    counts = {r.extension: tuple(r)[1:] for r in files.file_counts(spark, str(tmp_path)).collect()}
    assert counts == {"json": (4, 2, 1, 1, 4), "csv": (1, 0, 0, 0, 0), "": (1, 0, 0, 0, 0)}


def test_csv_rows_of_unreadable_files(spark, tmp_path):
    put(tmp_path / "a.csv", 'x,y\n1,"a\nb"\n2,c\n')
    put(tmp_path / "b.csv", b"x,y\n1,\xff\xfe\n")
    put(tmp_path / "c.csv", "")
    assert [files.csv_rows(spark, str(tmp_path / f"{n}.csv")) for n in "abcd"] == [2, 0, 0, 0]


BOUNDED = """
import resource, sys
sys.path.insert(0, {root!r})
from placeflow.sources import json_stream
with open({path!r}, "rb") as f:
    n = sum(1 for _ in json_stream.elements(f, False))
print(n, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""


def test_a_map_of_300_mb_in_bounded_memory(tmp_path):
    import os

    path, n = tmp_path / "big.json", 30_000
    raw = json.dumps({"medical_info_raw": "<div class='x'>{}</div>" * 430, "has_medical_info": True})
    with open(path, "w") as f:
        f.write("{")
        for i in range(n):
            f.write(("," if i else "") + f'"{i}": {raw}')
        f.write("}")
    assert path.stat().st_size > 295_000_000
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", BOUNDED.format(root=root, path=str(path))], capture_output=True, text=True, timeout=300)
    found, mb = map(int, out.stdout.split())
    path.unlink()
    assert found == n and mb < 300, out.stderr


def test_records_keep_their_schema(spark, tmp_path):
    put(tmp_path / "r_p1_of_1.json", {"1": {"reviews": [{"review_index": 1, "images": ["a"]}], "review_count": 1}, "2": {"reviews": "wrong"}})
    got = {r.place_id: r for r in files.checkpoint_map(spark, str(tmp_path / "r_p1_of_1.json"), BUNDLE).collect()}
    assert got["1"].reviews[0].images == ["a"] and got["1"].part == 1 and got["2"].reviews is None
    assert files.checkpoint_map(spark, str(tmp_path / "r_p1_of_1.json"), ENRICHMENT).count() == 2
