"""A paged source as a Spark data source: tasks fetch runs of pages side by side.

``fetch(offset, size, since)`` is the caller's: it returns the body of a response, or None.  It is called on the
executors, so what it needs must be reachable there.  The rows are ``page``, ``body``, the number of records ``n``
and the bound ``since`` that the responses were asked with: a filter on it is pushed into the requests.  Without one
all records are asked for, and ``since`` is null.  Land the rows once before they are used twice.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Iterator
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition

from medallion.functions.times import instant
from medallion.sources.pages import ENVELOPE_KEYS, PAGE_SIZE

Fetch = Callable[[int, int, datetime | None], str | None]

SCHEMA = "page bigint, body string, n int, since timestamp"


class PageRun(InputPartition):
    """Pages ``first`` to ``last``, which one task fetches."""

    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


def record_count(body: str | None) -> int:
    """Records of a response, by the rules of ``pages.unwrap``; none if it is no JSON."""
    try:
        parsed = json.loads(body or "")
    except ValueError:
        return 0
    held = [parsed] + ([parsed.get(k) for k in ENVELOPE_KEYS] if isinstance(parsed, dict) else [])
    return next((len(x) for x in held if isinstance(x, list)), 0)


class PageReader(DataSourceReader):
    def __init__(self, fetch: Fetch, pages: int, run: int, page_size: int):
        self.fetch, self.pages, self.run, self.page_size = fetch, pages, run, page_size
        self.since: datetime | None = None
        self.nothing = False

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes the bound that the responses are asked with, and leaves all other filters to Spark."""
        for found in filters:
            if isinstance(found, EqualTo) and found.attribute == ("since",):
                # responses asked with one bound are none of another
                self.nothing |= self.since not in (None, found.value)
                self.since = found.value
            else:
                yield found

    def partitions(self) -> list[InputPartition]:
        last = 0 if self.nothing else self.pages
        # without partitions Spark would read one that is None
        return [PageRun(first, min(first + self.run - 1, last)) for first in range(1, last + 1, self.run)] or [PageRun(1, 0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        """A run ends with its first short page: what lies behind that is not asked for."""
        for page in range(partition.first, partition.last + 1):
            body = self.fetch((page - 1) * self.page_size, self.page_size, self.since)
            if body is None:
                return
            n = record_count(body)
            yield page, body, n, self.since
            if n < self.page_size:
                return


def pages_of(spark: SparkSession, fetch: Fetch, pages: int, since: datetime | None = None, run: int = 16,
             page_size: int = PAGE_SIZE) -> DataFrame:
    """``page, body, n, since`` of the pages 1 to ``pages`` of a source, ``run`` pages a task.

    ``since`` is given here, and not as a filter by the caller, because Spark keeps the reader of a frame together
    with the filters that it has taken: a second filter of the same frame would find those of the first.

    ``pages`` may exceed what the source has: a task whose first page is short or missing fetches no more.  Pages
    behind the first short one of all are left to ``pages.keep_wanted_pages``.  ``fetch`` should retry by itself; a
    task that is repeated fetches its run again.
    """
    if pages < 0 or run < 1 or page_size < 1:
        raise ValueError("pages must not be negative; run and page_size must be 1 or more")
    kind = f"pages_{uuid.uuid4().hex}"

    class PageSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return kind

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> DataSourceReader:
            return PageReader(fetch, pages, run, page_size)

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PageSource)
    found = spark.read.format(kind).load()
    return found if since is None else found.where(F.col("since") == instant(since))
