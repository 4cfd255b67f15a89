import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from medallion.operators.commit import Files  # noqa: E402
from medallion.operators.lake import Lake  # noqa: E402
from medallion.session import build_session, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
           "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4",
           "spark.sql.sources.parallelPartitionDiscovery.threshold": "1000",
           "spark.driver.memory": "8g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    path = f"{shared_dir(spark)}/test-{uuid.uuid4().hex}"
    yield path
    Files(spark).delete(path)


@pytest.fixture
def make_lake(spark):
    made = []

    def make(**settings) -> Lake:
        tag = uuid.uuid4().hex[:12]
        root = f"{shared_dir(spark)}/test-lake-{tag}"
        made.append(Lake(spark, root, prefix=f"test_{tag}_", **settings).setup())
        return made[-1]

    yield make
    for lake in made:
        lake.drop()


def rows(df, *order):
    """Rows as tuples, sorted."""
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))
