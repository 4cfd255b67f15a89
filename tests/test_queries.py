"""Every registered query against its SQL twin, on whole tables."""

import datetime
import decimal

import duckdb
import pytest

import __spark_entry__ as registered
from workload.registry import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
    benchmark labels conversations""".split()


@pytest.fixture(scope="module")
def twin():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.fixture(scope="module", autouse=True)
def lakes_are_dropped(spark):
    """The lakes that the queries have made go when all have run."""
    before = {d.name for d in spark.catalog.listDatabases()}
    yield
    for d in spark.catalog.listDatabases():
        if d.name not in before:
            spark.sql(f"DROP DATABASE {d.name} CASCADE")


def printed(value):
    if isinstance(value, (float, decimal.Decimal)):
        return repr(float(value))
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def normal(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(printed(r[i]) for i in order) for r in found)


def test_every_query_has_its_twin():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(registered.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, twin, name):
    df = registered.queries()[name](spark, SF_DIR)
    result = twin.execute(registered.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert normal(df.columns, df.collect()) == normal(names, result.fetchall())


def test_entry(spark):
    assert registered.entry(spark).count() > 0
