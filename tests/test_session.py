import pytest

from medallion.session import prepare, shared_dir


class Cluster:
    """Looks like a session on a cluster without a shared folder."""

    class conf:
        @staticmethod
        def get(_key, default=None):
            return default

    class sparkContext:
        master, applicationId = "spark://host:7077", "app-x"


def test_a_cluster_needs_a_shared_folder(spark):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Cluster)
    assert shared_dir(spark) == shared_dir(spark)


def test_the_reducer_count_is_the_users(spark):
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    before = [spark.conf.get(k, None) for k in keys]
    prepare(spark)
    assert [spark.conf.get(k, None) for k in keys] == before
