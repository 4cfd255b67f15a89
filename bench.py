"""Wall seconds of the headline queries; prints one JSON line.

Every query runs to the end into the ``noop`` sink, so nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time
from datetime import datetime

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from medallion.contracts import ORDERS  # noqa: E402
from medallion.functions.times import instant  # noqa: E402
from medallion.operators.merge import upsert  # noqa: E402
from medallion.plans.entities import transform_orders  # noqa: E402
from medallion.session import build_session  # noqa: E402
from workload.adapters import orders_source  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

FRAMES = [
    "transform_orders", "transform_users", "transform_products", "agg_daily_sales",
    "daily_sales_gapfilled", "dedup_orders", "dedup_users", "dedup_max_by", "dedup_counts",
    "dim_customers", "fact_orders", "incremental_orders", "orders_by_updated", "orders_limit",
    "scan_paged_json", "unwrap_envelope", "explode_order_lines", "quality_report",
    "rows_loaded_by_run", "review_count", "mask_phone", "gen_orders",
]
TABLES = ["replace_products", "clustered_orders", "export_csv", "full_run_e2e",
          "incremental_orders_e2e", "stream_upsert_events"]


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def upserts(spark: SparkSession) -> dict[str, float]:
    """Upsert into a loaded table with a part of its keys changed."""
    from workload.registry import new_lake

    run = datetime(2024, 6, 1)
    lake = new_lake(spark, entities={"orders": ORDERS})
    clean = transform_orders(orders_source(spark, SF_DIR), run)
    seconds = {"upsert_initial": timed(lambda: upsert(lake, clean, ORDERS, instant(run)))}
    for share in (1, 10, 100):
        changed = clean.where(F.pmod(F.xxhash64("order_id"), F.lit(100)) < share)
        changed = changed.withColumn("total", F.col("total") + 1)
        seconds[f"upsert_{share}pct"] = timed(lambda: upsert(lake, changed, ORDERS, instant(run)))
    return seconds


def main() -> None:
    from workload import frames, pulls, scalars, tables  # noqa: F401
    from workload.registry import QUERIES

    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false",
        "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    drain(QUERIES["agg_daily_sales"](spark, SF_DIR))  # starts the executors
    seconds = {}
    for name in FRAMES + TABLES:
        seconds[name] = timed(lambda: drain(QUERIES[name](spark, SF_DIR)))
    seconds |= upserts(spark)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
