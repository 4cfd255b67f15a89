"""Session settings and the shared folder of the cluster."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile

from pyspark.sql import SparkSession

# No shuffle-partition count here: the cluster (or the test) knows its size,
# and AQE coalesces whatever it was given.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app: str = "medallion", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Read and write instants in UTC.  Nothing else of the session is changed.

    The number of reduce tasks is the cluster's matter: set
    ``spark.sql.adaptive.coalescePartitions.initialPartitionNum`` to the bytes
    that the largest shuffle moves, divided by some 200 MB (500,000 for 100
    TB); AQE joins the pieces of smaller shuffles.
    """
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Where nothing is configured, a local master (as in tests) gets a temporary
    folder, one for the application; on a cluster that is an error, since each
    executor would write to a disk of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on master {master}")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="medallion-")
        atexit.register(shutil.rmtree, _local[app], ignore_errors=True)
    return _local[app]
