"""Queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from medallion.llm.common import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(work):
        @functools.wraps(work)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return work(prepare(spark), sf_dir)

        QUERIES[work.__name__] = run
        if sql is not None:
            SQL[work.__name__] = sql
        return run

    return register
