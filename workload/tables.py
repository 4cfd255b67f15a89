"""Loads, merges, layer builds, runs and streams, read back from the tables.

Every call works in a lake of its own, so calls do not disturb each other.
"""

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.contracts import EVENTS, ORDERS, PRODUCTS, USERS, Entity
from medallion.functions.times import instant, to_utc
from medallion.operators.dedup import drop_duplicates
from medallion.operators.lake import Lake, clustered, export_csv as write_csv, replace
from medallion.operators.merge import insert_if_absent as add_absent
from medallion.operators.merge import upsert
from medallion.plans import control, entities
from medallion.plans.runs import run_full, run_incremental
from medallion.plans.warehouse import build_analytics, build_staging
from medallion.sources.pages import stamp
from medallion.sources.relational import changed_after, extract_orders
from medallion.streaming.upserts import read_landed, run_to_end, stream_upserts
from workload.adapters import (
    MARK_LOG, ORDERS_SOURCE, RUN_LOG, mark_log, orders_source, products_source, run_log, table,
    users_source,
)
from workload.registry import RUN_1, RUN_2, new_folder, new_lake, query
from workload.twins import DAILY, ORDERS as ORDERS_SQL, PRODUCTS as PRODUCTS_SQL, \
    USERS as USERS_SQL, ranked

T1, T2 = "TIMESTAMP '2024-06-01'", "TIMESTAMP '2024-06-02'"

# Orders created before LATE are loaded first; those changed after EARLY come
# in the second load.  The years between are updates, the later ones inserts.
EARLY, LATE = datetime(1998, 1, 1), datetime(1999, 1, 1)
EARLY_SQL, LATE_SQL = "TIMESTAMP '1998-01-01'", "TIMESTAMP '1999-01-01'"


# --- replace, merge, insert ------------------------------------------------


@query(f"""WITH {PRODUCTS_SQL} SELECT product_id, product_name, rating, reviews, price, stock,
    category, sk_product, {T2} AS _loaded_at FROM products_clean""")
def replace_products(spark: SparkSession, sf: str) -> DataFrame:
    lake = new_lake(spark, entities={"products": PRODUCTS})
    clean = entities.transform_products(products_source(spark, sf), RUN_1)
    replace(lake, clean.withColumn("stock", F.lit(0)), PRODUCTS, instant(RUN_1))
    replace(lake, clean, PRODUCTS, instant(RUN_2))
    replace(lake, clean.where(F.lit(False)), PRODUCTS, instant(RUN_2))  # no rows: nothing happens
    return lake.table("raw", PRODUCTS.table).select(
        "product_id", "product_name", "rating", "reviews", "price", "stock", "category",
        "sk_product", "_loaded_at")


@query(f"""WITH {ORDERS_SQL}, later AS (SELECT *, updated_at > {EARLY_SQL} AS changed
        FROM orders_clean)
    SELECT order_id, user_id, products_json,
        CASE WHEN changed THEN floor(total) ELSE total END AS total,
        CASE WHEN changed THEN order_date + to_days(40) ELSE order_date END AS order_date,
        updated_at, CASE WHEN order_date < {LATE_SQL} THEN {T1} ELSE {T2} END AS _loaded_at
    FROM later""")
def upsert_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The second load cuts the cents and moves the orders by forty days,
    that is into other partitions."""
    lake = new_lake(spark, entities={"orders": ORDERS})
    clean = entities.transform_orders(orders_source(spark, sf), RUN_1)
    changed = clean.where(F.col("updated_at") > instant(EARLY)).withColumns({
        "total": F.floor("total"), "order_date": F.col("order_date") + F.expr("INTERVAL 40 DAYS"),
    })
    upsert(lake, clean.where(F.col("order_date") < instant(LATE)), ORDERS, instant(RUN_1))
    upsert(lake, changed, ORDERS, instant(RUN_2))
    return lake.table("raw", ORDERS.table).select(
        "order_id", "user_id", "products_json", "total", "order_date", "updated_at", "_loaded_at")


LINES = Entity(
    name="lines", table="order_lines_raw",
    columns={"l_orderkey": "bigint", "l_linenumber": "int", "l_partkey": "bigint",
             "l_quantity": "double", "l_tax": "double", "l_shipdate": "timestamp",
             "_loaded_at": "timestamp"},
    keys=("l_orderkey", "l_linenumber"), required=("l_orderkey",), gate=("l_orderkey",),
    arrival=("l_shipdate",), marks=("l_shipdate",), watermark_name="incremental_lines",
    cluster=("l_orderkey", "l_linenumber"), date_key="l_shipdate",
)
_LINE_REST = ["l_partkey", "l_quantity", "l_tax"]


@query(f"""WITH lines AS (SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_quantity, l_tax
        FROM lineitem),
    last AS ({ranked('lines', ['l_orderkey', 'l_linenumber'], ['l_shipdate'], _LINE_REST)})
    SELECT l_orderkey, l_linenumber, l_partkey,
        CASE WHEN l_shipdate >= {EARLY_SQL} THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
        CASE WHEN l_shipdate < {LATE_SQL} THEN l_tax END AS l_tax, l_shipdate,
        CASE WHEN l_shipdate < {LATE_SQL} THEN {T1} ELSE {T2} END AS _loaded_at FROM last""")
def upsert_composite_key(spark: SparkSession, sf: str) -> DataFrame:
    """The second load has no tax: kept on update, null on insert."""
    lake = new_lake(spark, entities={"lines": LINES})
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", *_LINE_REST)
    last = drop_duplicates(lines, list(LINES.keys), ["l_shipdate"])
    early = F.lit(EARLY.isoformat()).cast("timestamp_ntz")
    late = F.lit(LATE.isoformat()).cast("timestamp_ntz")
    second = last.where(F.col("l_shipdate") >= early).drop("l_tax")
    upsert(lake, last.where(F.col("l_shipdate") < late), LINES, instant(RUN_1))
    upsert(lake, second.withColumn("l_quantity", F.col("l_quantity") + 1), LINES, instant(RUN_2))
    return lake.table("raw", LINES.table)


@query(f"""WITH {USERS_SQL}
    SELECT user_id, CASE WHEN user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
            THEN 'changed@example.com' ELSE email END AS email,
        full_name, phone_masked, CAST(address_lat AS DOUBLE) AS address_lat, sk_user,
        {T1} AS _loaded_at FROM users_clean
    UNION ALL SELECT -1 - s_suppkey, lower(s_name) || '@example.com', s_name, NULL, NULL,
        substr(sha256('user|' || (-1 - s_suppkey)), 1, 16), {T2} FROM supplier""")
def upsert_users(spark: SparkSession, sf: str) -> DataFrame:
    """Users in debt get another address, and the suppliers become users.
    The second load mentions few columns; the others stay on update."""
    lake = new_lake(spark, entities={"users": USERS})
    first = entities.transform_users(users_source(spark, sf), RUN_1)
    upsert(lake, first, USERS, instant(RUN_1))
    debtors = table(spark, sf, "customer").where("c_acctbal < 0").selectExpr(
        "c_custkey AS id", "'Changed@Example.com' AS email", "cast(null AS string) AS full_name")
    known = debtors.join(first.select("user_id", F.col("full_name").alias("old_name")),
                         F.col("id") == F.col("user_id"))
    known = known.select("id", "email", F.col("old_name").alias("full_name"))
    suppliers = table(spark, sf, "supplier").selectExpr(
        "-1 - s_suppkey AS id", "concat(s_name, '@example.com') AS email", "s_name AS full_name")
    second = entities.transform_users(known.unionByName(suppliers), RUN_2)
    upsert(lake, second, USERS, instant(RUN_2))
    return lake.table("raw", USERS.table).select(
        "user_id", "email", "full_name", "phone_masked", "address_lat", "sk_user", "_loaded_at")


@query(f"""WITH {PRODUCTS_SQL} SELECT product_id, product_name,
    CASE WHEN stock < 25 THEN price + 1 ELSE price END AS price, stock, dimensions,
    CASE WHEN stock >= 15 THEN {T1} ELSE {T2} END AS _loaded_at FROM products_clean""")
def upsert_products(spark: SparkSession, sf: str) -> DataFrame:
    """First the well-stocked products, then dearer ones with little stock."""
    lake = new_lake(spark, entities={"products": PRODUCTS})
    clean = entities.transform_products(products_source(spark, sf), RUN_1)
    upsert(lake, clean.where("stock >= 15"), PRODUCTS, instant(RUN_1))
    upsert(lake, clean.where("stock < 25").withColumn("price", F.col("price") + 1), PRODUCTS,
           instant(RUN_2))
    return lake.table("raw", PRODUCTS.table).select(
        "product_id", "product_name", "price", "stock", "dimensions", "_loaded_at")


@query(f"""WITH {ORDERS_SQL} SELECT order_id, user_id,
    CASE WHEN order_date < {LATE_SQL} THEN total ELSE 0 END AS total, order_date,
    CASE WHEN order_date < {LATE_SQL} THEN {T1} ELSE {T2} END AS _loaded_at FROM orders_clean""")
def insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    lake = new_lake(spark, entities={"orders": ORDERS})
    clean = entities.transform_orders(orders_source(spark, sf), RUN_1)
    add_absent(lake, clean.where(F.col("order_date") < instant(LATE)), ORDERS, instant(RUN_1),
               ["updated_at"])
    free = clean.withColumn("total", F.lit(0.0))
    add_absent(lake, free.unionByName(free), ORDERS, instant(RUN_2), ["updated_at"])
    return lake.table("raw", ORDERS.table).select(
        "order_id", "user_id", "total", "order_date", "_loaded_at")


@query(f"WITH {ORDERS_SOURCE} SELECT id, user_id, created_at, updated_at, status FROM orders_source")
def clustered_orders(spark: SparkSession, sf: str) -> DataFrame:
    rows = orders_source(spark, sf).select("id", "user_id", "created_at", "updated_at", "status")
    folder = new_folder(spark)
    clustered(rows, ["updated_at", "id"]).write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


@query(f"WITH {ORDERS_SQL} SELECT * EXCLUDE (_transformed_at) FROM orders_clean")
def export_csv(spark: SparkSession, sf: str) -> DataFrame:
    rows = entities.transform_orders(orders_source(spark, sf), RUN_1).drop("_transformed_at")
    path = write_csv(rows, new_folder(spark), "orders_transformed", RUN_1)
    return spark.read.option("header", True).option("escape", '"').schema(rows.schema).csv(path)


# --- control tables --------------------------------------------------------


@query(f"""WITH {MARK_LOG} SELECT pipeline_name, watermark_value, status, rows_loaded, recorded_at
    FROM mark_log UNION ALL SELECT 'incremental_click', {T1}, 'SUCCESS', 7, {T2}""")
def set_watermark(spark: SparkSession, sf: str) -> DataFrame:
    lake = new_lake(spark, entities={})
    control.append_control(lake, "etl_watermarks", mark_log(spark, sf))
    control.set_watermark(lake, "incremental_click", RUN_1, rows=7, recorded_at=RUN_2)
    return lake.table("control", "etl_watermarks")


@query(f"""WITH {RUN_LOG} SELECT * FROM run_log UNION ALL
    SELECT 'etl_main_pipeline', 'persist_metrics', 'run_1', 'daily_full', 'SUCCESS', 42, 1.5,
        NULL, {T1}""")
def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    lake = new_lake(spark, entities={})
    control.append_control(lake, "pipeline_run_metrics", run_log(spark, sf))
    control.record_metric(lake, "etl_main_pipeline", "persist_metrics", "run_1", "daily_full",
                          "SUCCESS", rows_loaded=42, duration_seconds=1.5, recorded_at=RUN_1)
    return lake.table("control", "pipeline_run_metrics")


@query(f"""WITH {RUN_LOG} SELECT dag_id, task_id, run_id, 'task_failure' AS run_type, status,
        0 AS rows_loaded, duration_seconds, substr(coalesce(error_message,
        'No exception details available.'), 1, 5000) AS error_message, recorded_at
    FROM run_log WHERE status = 'FAILED'
    UNION ALL SELECT 'etl_main_pipeline', 'load_orders', 'run_1', 'task_failure', 'FAILED', 0,
        86400.0, 'boom', {T2}""")
def failure_metrics(spark: SparkSession, sf: str) -> DataFrame:
    lake = new_lake(spark, entities={})
    control.append_control(lake, "pipeline_run_metrics", control.failures_of(run_log(spark, sf)))
    control.record_failure(lake, "etl_main_pipeline", "load_orders", "run_1", ValueError("boom"),
                           started=RUN_1, recorded_at=RUN_2)
    return lake.table("control", "pipeline_run_metrics")


# --- runs ------------------------------------------------------------------


def _sources(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "products": stamp(products_source(spark, sf), RUN_1, "/products"),
        "users": stamp(users_source(spark, sf), RUN_1, "/users"),
        "orders": stamp(extract_orders(orders_source(spark, sf)), RUN_1, "orders"),
    }


def _full(spark: SparkSession, sf: str) -> Lake:
    lake = new_lake(spark, entities={e.name: e for e in (ORDERS, USERS, PRODUCTS)})
    run_full(lake, _sources(spark, sf), "full_1", RUN_1)
    return lake


@query(f"WITH {ORDERS_SQL} {DAILY} FROM orders_clean GROUP BY 1")
def full_run_e2e(spark: SparkSession, sf: str) -> DataFrame:
    return _full(spark, sf).table("analytics", "agg_daily_sales")


@query(f"""WITH {ORDERS_SQL}, {USERS_SQL}, {PRODUCTS_SQL}, counts AS (
        SELECT 'orders' AS dataset, count(*) AS rows_loaded FROM orders_clean
        UNION ALL SELECT 'users', count(*) FROM users_clean
        UNION ALL SELECT 'products', count(*) FROM products_clean)
    SELECT * FROM counts UNION ALL SELECT 'total', sum(rows_loaded) FROM counts""")
def load_counts(spark: SparkSession, sf: str) -> DataFrame:
    lake = _full(spark, sf)
    metrics = lake.table("control", "pipeline_run_metrics").where("run_id = 'full_1'")
    counts = metrics.select(F.lit("total").alias("dataset"), "rows_loaded")
    for entity in (ORDERS, USERS, PRODUCTS):
        loaded = lake.table("raw", entity.table).agg(F.count(F.lit(1)).alias("rows_loaded"))
        counts = counts.unionByName(loaded.select(F.lit(entity.name).alias("dataset"),
                                                  "rows_loaded"))
    return counts


def _two_increments(spark: SparkSession, sf: str) -> Lake:
    """A first run that sees the orders changed until LATE, and a second one
    that sees all of them and has to take the rest."""
    lake = new_lake(spark, entities={"orders": ORDERS})
    source = orders_source(spark, sf)
    until = F.lit(LATE.isoformat()).cast("timestamp_ntz")
    then = source.where(F.col("updated_at") <= until)
    run_incremental(lake, {"orders": lambda mark: extract_orders(then, mark)}, "inc_1", RUN_1)
    run_incremental(lake, {"orders": lambda mark: extract_orders(source, mark)}, "inc_2", RUN_2)
    return lake


@query(f"""WITH {ORDERS_SQL} SELECT order_id, user_id, products_json, total, discounted_total,
    order_date, updated_at, sk_order,
    CASE WHEN updated_at <= {LATE_SQL} THEN {T1} ELSE {T2} END AS _loaded_at FROM orders_clean""")
def incremental_orders_e2e(spark: SparkSession, sf: str) -> DataFrame:
    return _two_increments(spark, sf).table("raw", ORDERS.table).select(
        "order_id", "user_id", "products_json", "total", "discounted_total", "order_date",
        "updated_at", "sk_order", "_loaded_at")


@query(f"""WITH {ORDERS_SOURCE}
    SELECT 'incremental_orders' AS pipeline_name, max(updated_at) AS watermark_value,
        count(DISTINCT id) AS rows_loaded FROM orders_source WHERE updated_at <= {LATE_SQL}
    UNION ALL SELECT 'incremental_orders', max(updated_at), count(DISTINCT id) FROM orders_source
        WHERE updated_at > {LATE_SQL}""")
def advance_watermarks(spark: SparkSession, sf: str) -> DataFrame:
    return _two_increments(spark, sf).table("control", "etl_watermarks").select(
        "pipeline_name", "watermark_value", "rows_loaded")


@query(f"""WITH {PRODUCTS_SQL} SELECT product_id, {T1} AS _loaded_at,
    (SELECT max(updated_at) FROM products_source) AS mark FROM products_clean""")
def empty_increment(spark: SparkSession, sf: str) -> DataFrame:
    """Nothing has changed since the mark: no row is loaded, no mark is set."""
    lake = new_lake(spark, entities={"products": PRODUCTS})
    source = products_source(spark, sf)
    pull = {"products": lambda mark: stamp(changed_after(source, mark), RUN_1, "/products")}
    run_incremental(lake, pull, "inc_1", RUN_1)
    run_incremental(lake, pull, "inc_2", RUN_2)
    mark = lake.table("control", "etl_watermarks").agg(F.max("watermark_value")).scalar()
    return lake.table("raw", PRODUCTS.table).select(
        "product_id", "_loaded_at", mark.alias("mark"))


@query(f"WITH {ORDERS_SQL} {DAILY} FROM orders_clean GROUP BY 1")
def incremental_build_e2e(spark: SparkSession, sf: str) -> DataFrame:
    """Two increments, each followed by a build that follows the history of the raw orders."""
    lake = new_lake(spark, entities={e.name: e for e in (ORDERS, USERS, PRODUCTS)})
    source = orders_source(spark, sf)
    until = F.lit(LATE.isoformat()).cast("timestamp_ntz")
    for n, rows in enumerate((source.where(F.col("updated_at") <= until), source)):
        run_incremental(lake, {"orders": lambda mark, rows=rows: extract_orders(rows, mark)}, f"inc_{n}", RUN_1)
        build_staging(lake)
        build_analytics(lake)
    return lake.table("analytics", "agg_daily_sales")


@query(f"""WITH {ORDERS_SQL} SELECT order_id, user_id, products_json, total, discounted_total, order_date, updated_at,
    sk_order FROM orders_clean""")
def incremental_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Facts of all orders after the orders of one day have been corrected and corrected back, each with a build."""
    lake = new_lake(spark, entities={e.name: e for e in (ORDERS, USERS, PRODUCTS)})
    clean = entities.transform_orders(orders_source(spark, sf), RUN_1)
    one_day = clean.where(F.to_date("order_date") == F.lit(LATE.date()))
    for rows in (clean, one_day.withColumn("total", F.col("total") + 1), one_day):
        upsert(lake, rows, ORDERS, instant(RUN_1))
        build_staging(lake)
        build_analytics(lake)
    return lake.table("analytics", "fact_orders").select(
        "order_id", "user_id", "products_json", "total", "discounted_total", "order_date", "updated_at", "sk_order")


@query(f"""WITH {USERS_SQL} SELECT user_id, email, full_name, phone_masked, sk_user,
    CASE WHEN user_id % 5 < 2 THEN {T2} ELSE {T1} END AS _loaded_at FROM users_clean""")
def grow_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """Users that come in two waves to a table with small buckets: those of the first are split as the second comes."""
    lake = new_lake(spark, entities={"users": USERS}, bucket_rows=400)
    clean = entities.transform_users(users_source(spark, sf), RUN_1)
    upsert(lake, clean.where("pmod(user_id, 5) >= 2"), USERS, instant(RUN_1))
    upsert(lake, clean.where("pmod(user_id, 5) < 2"), USERS, instant(RUN_2))
    return lake.table("raw", USERS.table).select("user_id", "email", "full_name", "phone_masked", "sk_user", "_loaded_at")


@query(f"""WITH {ORDERS_SQL} SELECT order_id, user_id, total, updated_at,
    CASE WHEN order_id % 10 = 0 THEN {T2} ELSE {T1} END AS _transformed_at,
    CASE WHEN order_id % 10 = 0 THEN {T2} ELSE {T1} END AS _loaded_at FROM orders_clean""")
def overlapping_pull(spark: SparkSession, sf: str) -> DataFrame:
    """Orders that were committed behind the mark are caught by a pull that overlaps the one before; the others stay."""
    lake = new_lake(spark, entities={"orders": ORDERS})
    source = orders_source(spark, sf)
    for n, (ts, rows) in enumerate(((RUN_1, source.where("pmod(id, 10) > 0")), (RUN_2, source))):
        run_incremental(lake, {"orders": lambda mark, rows=rows: extract_orders(rows, mark)}, f"inc_{n}", ts,
                        overlap=timedelta(days=40_000))
    return lake.table("raw", ORDERS.table).select("order_id", "user_id", "total", "updated_at", "_transformed_at", "_loaded_at")


@query("""SELECT event_id, ts, user_id, event_type, value FROM events""")
def repeated_batch(spark: SparkSession, sf: str) -> DataFrame:
    """A batch of a stream that comes again, with other values, after its commit: it counts once."""
    lake = new_lake(spark, entities={"events": EVENTS})
    events = table(spark, sf, "events")
    typed = events.withColumn("ts", to_utc(F.col("ts"), events.schema["ts"].dataType))
    upsert(lake, typed, EVENTS, instant(RUN_1), batch=("events", 0))
    upsert(lake, typed.withColumn("value", F.lit(-1.0)), EVENTS, instant(RUN_2), batch=("events", 0))
    return lake.table("raw", EVENTS.table).select("event_id", "ts", "user_id", "event_type", "value")


# --- stream ----------------------------------------------------------------


@query(f"""SELECT event_id, CASE WHEN event_type = 'error' THEN ts + INTERVAL 1 HOUR ELSE ts END AS ts,
    user_id, CASE WHEN event_type = 'error' THEN 'fixed' ELSE event_type END AS event_type, value,
    props, {T1} AS _loaded_at FROM events""")
def stream_upsert_events(spark: SparkSession, sf: str) -> DataFrame:
    """All events land, and later the corrected errors land again."""
    lake = new_lake(spark, entities={"events": EVENTS})
    folder = new_folder(spark)
    events = table(spark, sf, "events")
    fixed = events.where("event_type = 'error'").withColumns({
        "ts": F.col("ts") + F.expr("INTERVAL 1 HOUR"), "event_type": F.lit("fixed")})
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in events.schema.fields)
    for wave in (events, fixed):
        wave.write.mode("append").parquet(f"{folder}/landed")
        stream = read_landed(lake, f"{folder}/landed", schema)
        typed = stream.withColumn("ts", to_utc(F.col("ts"), stream.schema["ts"].dataType))
        run_to_end(lake, stream_upserts(lake, typed, EVENTS, f"{folder}/checkpoint", RUN_1), EVENTS)
    return lake.table("raw", EVENTS.table)
