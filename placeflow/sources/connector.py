"""A Python data source over captured search pages: one input partition for each task, bounded retries in the reader."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from placeflow.functions import html


#: Characters of the pages option, which goes to every reader.
LARGEST = 4_000_000


class Task(InputPartition):
    def __init__(self, location: str, query: str):
        super().__init__(f"{location} {query}")
        self.location, self.query = location, query


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.tasks = [Task(*t) for t in json.loads(options.get("tasks", "[]"))]
        if len(options.get("pages", "")) > LARGEST:
            raise ValueError("these pages are too large for an option: keep them in a table and read it by pages.search_hits")
        self.pages = json.loads(options.get("pages", "{}"))
        self.most = int(options["max_pages"]) if "max_pages" in options else None

    def partitions(self) -> list[InputPartition]:
        return self.tasks or [Task("", "")]

    def read(self, task: Task) -> Iterator[tuple]:
        seen: set[str] = set()
        for number, page in enumerate(self.pages.get(task.value, [])[: self.most], 1):
            for item in html.search_items(page):
                if item["name"] not in seen:
                    seen.add(item["name"])
                    yield task.query, task.location, number, len(seen), item["name"], item["href"]
            if not html.more_pages(page):
                return


class CapturedSearch(DataSource):
    """A small set of pages (`LARGEST` characters); more of them belong in a table, for `pages.search_hits`. A page whose last paging button is disabled ends a search.

    Options: tasks (JSON list of [location, query]), pages (JSON of "location query" to a list of pages), max_pages.
    """

    @classmethod
    def name(cls) -> str:
        return "captured_search"

    def schema(self) -> str:
        return "search_query string, search_location string, page_number int, position int, preview_name string, url string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)
