"""Each command on small inputs."""

import json

import pytest

from placeflow import cli
from placeflow.sinks import files as sinks

PAGE = '<div class="DAQTB"><h3 class="fr6Pj">진료과목</h3><ul class="xrrcZ"><li class="zxtJF">내과</li></ul></div><ul id="_review_list"><li class="place_apply_pui"></li></ul>'


def test_commands(spark, tmp_path):
    t = str(tmp_path)
    spark.createDataFrame([("1", "가의원", "방문자 1"), ("2", "나병원", None)], "place_id string, name string, reviews string").write.parquet(f"{t}/places")
    spark.createDataFrame([("http://x/place/1", PAGE)], "url string, html string").write.parquet(f"{t}/pages")
    common = ["--places", f"{t}/places", "--pages", f"{t}/pages"]
    assert cli.main(["enrich", *common, "--state", f"{t}/s"], spark).count() == 2
    for x in ("1", "2"):
        cli.main(["reviews", *common, "--state", f"{t}/r{x}", "--output", f"{t}/out", "--partition-x", x, "--partition-y", "2"], spark)
    assert cli.main(["merge", "--data-dir", f"{t}/out", "--output", f"{t}/all", "--partitions", "2", "--stem", "reviews_p"], spark).count() == 2
    assert cli.main(["sample", "--places", f"{t}/places", "--num", "2"], spark).count() == 1 + 1
    assert cli.main(["sample", "--places", f"{t}/places", "--num", "2", "--pages", f"{t}/pages", "--output", f"{t}/try"], spark).count() == 2
    for x in ("0", "1"):
        cli.main(["enrich", *common, "--state", f"{t}/e{x}", "--partition", x, "--total", "2", "--export", f"{t}/states"], spark)
    assert cli.main(["merge-state", "--files", f"{t}/states/enrichment_progress_partition_*.json", "--output", f"{t}/whole.json"], spark).count() == 2
    assert sorted(json.loads((tmp_path / "whole.json").read_text())) == ["1", "2"]
    (tmp_path / "tree/g/d").mkdir(parents=True)
    (tmp_path / "tree/g/d/k.json").write_text('[{"name": "x"}]')
    assert len(cli.main(["merge-tree", "--data-dir", f"{t}/tree", "--output", f"{t}/merged"], spark)) == 2
    sent = []

    class Kept(sinks.Publisher):
        def publish(self, name, files, private=False):
            sent.append((name, len(files), private))

    publish = ["publish", "--data-dir", f"{t}/tree", "--output", f"{t}/published", "--repo-name", "a/b"]
    assert cli.main([*publish, "--private"], spark, Kept())["n_rows"] == 1 and sent == [("a/b", 2, True)]
    assert cli.main([*publish, "--no-upload"], spark)["n_rows"] == 1
    with pytest.raises(NotImplementedError):
        cli.main(publish, spark)
    (tmp_path / "sum").mkdir()
    (tmp_path / "sum/a.json").write_text(json.dumps({"gu": "g", "dong": "d", "completed_keywords": ["a"], "failed_keywords": [], "total_facilities": 4}))
    assert cli.main(["progress", "--summaries", f"{t}/sum", "--total", "4", "--output", f"{t}/progress.json"], spark).first().completion_percentage == 25.0
    with pytest.raises(ValueError):
        cli.main(["reviews", *common, "--state", f"{t}/r", "--output", f"{t}/out", "--partition-x", "3", "--partition-y", "2"], spark)
    with pytest.raises(SystemExit):
        cli.parser().parse_args([])
