"""Registry of the queries and of the SQL each is compared with."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.lake import Lake
from medallion.session import prepare, shared_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Fixed run times, so that results can be compared.
RUN_1 = datetime(2024, 6, 1)
RUN_2 = datetime(2024, 6, 2)


def comparable(df: DataFrame) -> DataFrame:
    """Types both engines print alike: zone-less timestamps, doubles."""
    def same(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            return column.cast("timestamp_ntz").alias(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        return column

    return df.select(*[same(f) for f in df.schema.fields])


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(work: Query) -> Query:
        @functools.wraps(work)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(work(prepare(spark), sf_dir))

        key = name or work.__name__
        QUERIES[key] = run
        if sql is not None:
            SQL[key] = sql
        return run

    return register


def new_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/medallion-{uuid.uuid4().hex}"


def new_lake(spark: SparkSession, **settings) -> Lake:
    """A lake of its own for each call, in the shared folder."""
    tag = uuid.uuid4().hex[:12]
    root = f"{shared_dir(spark)}/lake-{tag}"
    return Lake(spark, root, prefix=f"lake_{tag}_", **settings).setup()
