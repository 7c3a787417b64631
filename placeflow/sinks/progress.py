"""The progress file of a run that several workers write at once."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from placeflow import storage
from placeflow.operators import stats
from placeflow.sinks.files import pretty, progress_figures

#: Versions that stay for readers that have just found their number.
KEPT = 5


class Progress:
    """A document at path, and its numbered versions in a folder beside it.

    A writer adds its summaries to the last version and puts the next one; if
    another took that number first, it adds them to that one instead, so no
    summary is lost and none counts twice. The file at path is then replaced in
    one step. A crash before that leaves it a version behind, and whoever reads
    next mends it. A file without versions is where they start from.
    """

    def __init__(self, spark: SparkSession, path: str, total: int):
        self.spark, self.path, self.total = spark, path, total
        folder, _, name = path.rpartition("/")
        # a leading underscore, so that readers of the folder pass over it
        self.versions = storage.Versions(spark, f"{folder or '.'}/_{name}.versions")

    def _last(self) -> tuple[int, dict | None]:
        number, document = self.versions.last()
        if document is None and storage.exists(self.spark, self.path):
            document = json.loads(storage.read_text(self.spark, self.path))
        return number, document

    def read(self) -> dict | None:
        """The last version; None before the first."""
        number, document = self._last()
        if number and (not storage.exists(self.spark, self.path) or storage.read_text(self.spark, self.path) != pretty(document)):
            storage.replace(self.spark, self.path, [pretty(document)])
        return document

    def add(self, summaries: DataFrame) -> dict:
        """Adds run summaries: neighbourhoods not completed before, hits, credit by keyword."""
        new = progress_figures(stats.progress(summaries, self.total))
        while True:
            number, old = self._last()
            document = self.merged(old, new)
            if self.versions.put(number + 1, document):
                break
        document = self.read()
        self.versions.forget(number + 1 - KEPT)
        return document

    def merged(self, old: dict | None, new: dict) -> dict:
        if old is None:
            return new
        seen = set(old["completed_dongs"])
        done = old["completed_dongs"] + [d for d in new["completed_dongs"] if d not in seen]
        a, b = old["statistics"], new["statistics"]
        by = {k: a["by_keyword"].get(k, 0) + b["by_keyword"].get(k, 0) for k in {**a["by_keyword"], **b["by_keyword"]}}
        times = lambda name, pick: pick((d[name] for d in (old, new) if d.get(name)), default=None)
        return {
            "completed_dongs": done,
            "statistics": {"total_dongs_completed": len(done), "total_facilities": a["total_facilities"] + b["total_facilities"], "by_keyword": by},
            "start_time": times("start_time", min),
            "last_updated": times("last_updated", max),
            "completion_percentage": 100.0 * len(done) / self.total if self.total else None,
        }
