from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from medallion.contracts import EVENTS, ORDERS, PRODUCTS, USERS
from medallion.functions.times import instant
from medallion.operators import commit as commits
from medallion.operators.merge import upsert
from medallion.operators.quality import QualityError
from medallion.plans import control
from medallion.plans.runs import run_full, run_incremental
from medallion.plans.warehouse import build_analytics, build_staging
from medallion.sources.relational import extract_orders
from medallion.streaming.upserts import read_landed, run_to_end, stream_upserts
from tests.conftest import rows

RUN, NEXT = datetime(2024, 6, 1), datetime(2024, 6, 2)


def utc(*parts):
    return datetime(*parts, tzinfo=timezone.utc)


@pytest.fixture
def lake(make_lake):
    return make_lake(entities={e.name: e for e in (ORDERS, USERS, PRODUCTS)})


def orders(spark, count, hour=0):
    return spark.range(1, count + 1).selectExpr(
        "id", "id % 3 AS user_id", "'[]' AS products", "CAST(id AS decimal(10,2)) AS total",
        "CAST(id AS decimal(10,2)) AS discounted_total", "1 AS total_products",
        "1 AS total_quantity", "timestamp'2024-01-01 00:00:00' AS created_at",
        f"timestamp'2024-01-01 00:00:00' + make_dt_interval(0, CAST(id AS int) + {hour}) AS updated_at")


def users(spark, count):
    return spark.range(1, count + 1).selectExpr("id", "concat(id, '@x.org') AS email")


def products(spark, count):
    return spark.range(1, count + 1).selectExpr("id", "concat('p', id) AS title", "1.5D AS price")


def count(lake, layer, table):
    return lake.table(layer, table).count()


def test_watermarks(lake):
    assert control.get_watermark(lake, "p") is None
    control.set_watermark(lake, "p", utc(2024, 1, 9), status="FAILED")
    assert control.get_watermark(lake, "p") is None
    control.set_watermark(lake, "p", datetime(2024, 1, 2, 3, 4, 5, 678), rows=5)
    control.set_watermark(lake, "p", utc(2024, 1, 1))
    control.set_watermark(lake, "other", utc(2024, 5, 1))
    assert control.get_watermark(lake, "p") == utc(2024, 1, 2, 3, 4, 5, 678)
    assert not control.advance_watermark(lake, "p", 0, utc(2024, 3, 1))
    assert not control.advance_watermark(lake, "p", 5, None)
    assert control.advance_watermark(lake, "p", 5, utc(2024, 3, 1))
    assert control.get_watermark(lake, "p") == utc(2024, 3, 1)


def test_next_watermark_is_the_first_candidate_with_a_value(spark):
    df = spark.sql("""SELECT CAST(NULL AS string) AS updated_at, '2024-01-01' AS created_at,
        timestamp'2024-05-01 00:00:00' AS _extracted_at UNION ALL SELECT 'bad', 'bad', NULL""")
    found = control.next_watermark(df, ORDERS.marks).select(F.col("next_watermark").cast("string"))
    assert found.first()[0] == "2024-01-01 00:00:00"
    assert control.next_watermark(df.select("updated_at"), ORDERS.marks).first()[0] is None
    assert control.next_watermark(spark.range(1), ORDERS.marks).first()[0] is None
    assert control.pick_mark({"updated_at": None, "created_at": 1}, ORDERS.marks) == utc(
        1970, 1, 1, 0, 0, 0, 1)


def test_incremental_gate():
    assert control.incremental_gate({"a": 0, "b": 2})
    assert not control.incremental_gate({"a": 0, "b": 0})
    with pytest.raises(ValueError, match="invalid row counts"):
        control.incremental_gate({"a": -1, "b": 2})


def test_metrics_are_recorded_and_never_raise(lake):
    assert control.record_metric(lake, "d", "t", "r", "daily_full", "SUCCESS", rows_loaded=3,
                                 duration_seconds=1.5)
    assert control.record_failure(lake, "d", "t", "r", ValueError("x" * 9000), RUN, NEXT)
    assert control.record_failure(lake, "d", "t", "r", None)
    found = rows(lake.table("control", "pipeline_run_metrics").select(
        "run_type", "status", "rows_loaded", "duration_seconds", F.length("error_message")))
    assert found == [("daily_full", "SUCCESS", 3, 1.5, None),
                     ("task_failure", "FAILED", 0, 86400.0, 5000),
                     ("task_failure", "FAILED", 0, None, 31)]
    lake.spark.sql(f"DROP TABLE {lake.name('control', 'pipeline_run_metrics')}")
    assert not control.record_metric(lake, "d", "t", "r", "daily_full", "SUCCESS")


def test_full_run(spark, lake):
    sources = {"orders": orders(spark, 6), "users": users(spark, 4), "products": products(spark, 5)}
    assert run_full(lake, sources, "r1", RUN) == {"orders": 6, "users": 4, "products": 5}
    for layer, table, n in (("raw", "orders_raw", 6), ("staging", "stg_users", 4),
                            ("analytics", "fact_orders", 6), ("analytics", "dim_customers", 4),
                            ("analytics", "dim_products", 5), ("analytics", "agg_daily_sales", 1)):
        assert count(lake, layer, table) == n, table
    assert lake.table("analytics", "agg_daily_sales").first()[1:] == (6, 21.0, 3.5, 3)
    # Products are replaced, orders and users merged.
    sources |= {"products": products(spark, 2), "orders": orders(spark, 8, hour=1)}
    run_full(lake, sources, "r2", NEXT)
    assert (count(lake, "raw", "products_raw"), count(lake, "raw", "orders_raw")) == (2, 8)
    assert count(lake, "analytics", "dim_products") == 2
    assert rows(control.rows_loaded_by_run(lake.table("control", "pipeline_run_metrics"))) == [
        ("r1", 15), ("r2", 14)]


def test_full_run_stops_at_the_gate(spark, lake):
    undated = orders(spark, 3).withColumn("created_at", F.lit("never"))
    with pytest.raises(QualityError, match="order_date"):
        run_full(lake, {"orders": undated}, "r1", RUN)
    with pytest.raises(QualityError, match="no rows"):
        run_full(lake, {"orders": orders(spark, 0)}, "r2", RUN)
    assert count(lake, "raw", "orders_raw") == 0
    failures = lake.table("control", "pipeline_run_metrics")
    assert rows(failures.select("run_id", "task_id", "status")) == [
        ("r1", "load_orders", "FAILED"), ("r2", "load_orders", "FAILED")]


def test_increments_add_up_to_a_full_load(spark, lake, make_lake):
    def pull(source):
        return {"orders": lambda mark: extract_orders(source, mark)}

    assert run_incremental(lake, pull(orders(spark, 5)), "i1", RUN) == {"orders": 5}
    assert control.get_watermark(lake, "incremental_orders") == utc(2024, 1, 1, 5)
    assert run_incremental(lake, pull(orders(spark, 9)), "i2", RUN) == {"orders": 4}
    assert control.get_watermark(lake, "incremental_orders") == utc(2024, 1, 1, 9)
    assert run_incremental(lake, pull(orders(spark, 9)), "i3", RUN) == {"orders": 0}
    assert count(lake, "control", "etl_watermarks") == 2
    whole = make_lake(entities=lake.entities)
    run_full(whole, {"orders": orders(spark, 9)}, "f", RUN)
    assert rows(lake.table("raw", "orders_raw")) == rows(whole.table("raw", "orders_raw"))
    assert rows(lake.table("control", "pipeline_run_metrics").select("run_id", "rows_loaded")) == [
        ("i1", 5), ("i2", 4), ("i3", 0)]


def test_marks_come_from_rows_as_extracted(spark, lake):
    """A row that the cleaning drops still moves the mark."""
    source = orders(spark, 5).withColumn("user_id", F.when(F.col("id") < 5, F.col("user_id")))
    run_incremental(lake, {"orders": lambda mark: extract_orders(source, mark)}, "i1", RUN)
    assert count(lake, "raw", "orders_raw") == 4
    assert control.get_watermark(lake, "incremental_orders") == utc(2024, 1, 1, 5)


def test_a_failed_branch_moves_no_mark(spark, lake):
    def pull(mark):
        return extract_orders(orders(spark, 5), mark)

    twice = users(spark, 3).withColumn("oops", F.raise_error(F.lit("source lost")))
    broken = twice.withColumn("email", F.coalesce(F.col("oops").cast("string"), F.col("email")))
    with pytest.raises(Exception, match="source lost"):
        run_incremental(lake, {"orders": pull, "users": lambda mark: broken}, "i1", RUN)
    assert control.get_watermark(lake, "incremental_orders") is None
    # The repeated pull loads the same rows once more.
    assert run_incremental(lake, {"orders": pull}, "i2", RUN) == {"orders": 5}
    assert count(lake, "raw", "orders_raw") == 5


def event_file(spark, folder, lines):
    spark.createDataFrame(lines, "event_id bigint, ts string, value double").selectExpr(
        "event_id", "CAST(ts AS timestamp) AS ts", "value").coalesce(1).write.mode("append").parquet(folder)


def test_stream_of_landed_files(spark, make_lake, folder):
    lake = make_lake(entities={"events": EVENTS})
    landed, checkpoint = f"{folder}/landed", f"{folder}/checkpoint"

    def run():
        stream = read_landed(lake, landed, "event_id bigint, ts timestamp, value double", 1)
        run_to_end(lake, stream_upserts(lake, stream, EVENTS, checkpoint, RUN), EVENTS)
        return rows(lake.table("raw", EVENTS.table).select("event_id", "value"))

    event_file(spark, landed, [(1, "2024-01-01", 1.0), (2, "2024-02-01", 2.0)])
    event_file(spark, landed, [(2, "2024-02-02", 2.5), (2, "2024-02-03", 2.75), (3, "2024-03-01", 3.0)])
    assert run() == [(1, 1.0), (2, 2.75), (3, 3.0)]
    event_file(spark, landed, [(1, "2024-03-05", 1.5)])
    assert run() == [(1, 1.5), (2, 2.75), (3, 3.0)]
    assert run() == [(1, 1.5), (2, 2.75), (3, 3.0)]

    # the driver is lost after the last batch was merged and before the checkpoint says so: it counts once
    place = lake.raw_place(EVENTS)
    before, files = commits.last_version(place), place.files
    upsert(lake, spark.createDataFrame([(1, 9.0)], "event_id bigint, value double"), EVENTS, instant(RUN))
    for name in files.names(f"{checkpoint}/commits"):
        if name.lstrip(".").startswith("2"):
            files.delete(f"{checkpoint}/commits/{name}")
    assert run() == [(1, 9.0), (2, 2.75), (3, 3.0)] and commits.last_version(place) == before + 1
    # a stream with another checkpoint begins anew
    checkpoint = f"{folder}/other"
    assert run() == [(1, 1.5), (2, 2.75), (3, 3.0)]


def test_a_source_that_is_down_leaves_a_failure_row(spark, lake):
    def down(*_):
        raise ConnectionError("source is down")

    with pytest.raises(ConnectionError):
        run_full(lake, {"orders": down, "users": users(spark, 2)}, "f1", RUN)
    with pytest.raises(ConnectionError):
        run_incremental(lake, {"orders": down}, "i1", RUN)
    failures = lake.table("control", "pipeline_run_metrics")
    assert rows(failures.select("run_id", "task_id", "status", "error_message")) == [
        ("f1", "load_orders", "FAILED", "source is down"), ("i1", "upsert_orders", "FAILED", "source is down")]
    assert count(lake, "raw", "users_raw") == 2


def test_control_logs_are_compacted(lake):
    for i in range(6):
        control.set_watermark(lake, f"p{i % 2}", datetime(2024, 1, 1 + i))
    assert not control.compact(lake, "etl_watermarks", files=6)
    assert control.compact(lake, "etl_watermarks", files=5)
    assert len(lake.spark.table(lake.name("control", "etl_watermarks")).inputFiles()) < 6
    control.set_watermark(lake, "p0", datetime(2024, 2, 1))
    assert count(lake, "control", "etl_watermarks") == 7
    assert control.get_watermark(lake, "p0") == utc(2024, 2, 1)


def test_orders_are_sorted_by_day_in_the_files(spark, lake):
    days = orders(spark, 40).withColumn("created_at", F.expr(
        "timestamp'2024-01-01 00:00:00' + make_dt_interval(CAST(id * 7 % 28 AS int))"))
    run_full(lake, {"orders": days}, "r", RUN)
    for layer, table in (("staging", "stg_orders"), ("analytics", "fact_orders")):
        for path in lake.spark.table(lake.name(layer, table)).inputFiles():
            found = [r[0] for r in spark.read.parquet(path).select("order_date").collect()]
            assert found == sorted(found)


def spread(spark, count, first=1, **changes):
    """Orders of four months, one in ten without a date."""
    days = orders(spark, first + count - 1).where(F.col("id") >= first).withColumn("created_at", F.expr(
        "IF(id % 10 = 0, NULL, timestamp'2024-01-01 00:00:00' + make_dt_interval(CAST(id * 7 % 120 AS int)))"))
    return days.withColumns({c: F.expr(v) for c, v in changes.items()})


LAYERS = [("staging", t) for t in ("stg_orders", "stg_users", "stg_products")] + [
    ("analytics", t) for t in ("fact_orders", "agg_daily_sales", "dim_customers", "dim_products")]


def build(lake, full=False):
    build_staging(lake, full)
    build_analytics(lake, full)
    return {t: rows(lake.table(layer, t)) for layer, t in LAYERS}


def test_builds_touch_only_what_has_changed(spark, make_lake):
    """Hourly increments against full builds of the same raw tables."""
    lake = make_lake(entities={e.name: e for e in (ORDERS, USERS, PRODUCTS)}, bucket_rows=10)
    run_incremental(lake, {"orders": lambda _: spread(spark, 300), "users": lambda _: users(spark, 30),
                           "products": lambda _: products(spark, 9)}, "r", RUN)
    build(lake)
    places = {t: lake.place(layer, t) for layer, t in LAYERS}

    def versions():
        return {t: commits.last_version(p) for t, p in places.items()}

    def where(table):
        return {path.rsplit("/", 1)[1]: path for path in commits.locations(places[table])}

    before, at = versions(), {t: where(t) for t in ("stg_orders", "fact_orders")}
    known = build(lake)
    assert versions() == before  # nothing has changed, nothing is written

    run_incremental(lake, {"orders": lambda _: spread(spark, 3, 7, total="5.25", user_id="99").where("id = 7")}, "h", NEXT)
    found, after = build(lake), versions()
    month = F.date_format(F.expr("timestamp'2024-01-01' + make_dt_interval(49)"), "yyyy-MM")
    touched = {f"_part={spark.range(1).select(month).first()[0]}"}
    for table in ("stg_orders", "fact_orders"):
        now = where(table)
        assert {p for p in now if now[p] != at[table].get(p)} == touched and now.keys() == at[table].keys()
    assert {t for t in after if after[t] != before[t]} == {"stg_orders", "fact_orders", "agg_daily_sales"}
    assert found["agg_daily_sales"] != known["agg_daily_sales"] and build(lake, full=True) == found

    # orders that move to other months and lose their date, a month that empties, buckets that are split
    moves = [{"orders": lambda _: spread(spark, 40, 20, created_at="timestamp'2025-03-04 05:06:07'")},
             {"orders": lambda _: spread(spark, 20, 40, created_at="CAST(NULL AS timestamp)"), "users": lambda _: users(spark, 90)},
             {"users": lambda _: users(spark, 2).withColumn("email", F.lit("new@x.org")), "products": lambda _: products(spark, 40)}]
    for n, sources in enumerate(moves):
        run_incremental(lake, sources, f"h{n}", NEXT)
        found = build(lake)
        assert build(lake, full=True) == found
    assert lake.bucket_count(USERS) == 16 and count(lake, "staging", "stg_users") == 90


def test_a_build_that_missed_the_history_is_a_full_one(spark, lake, monkeypatch):
    monkeypatch.setattr(commits, "HISTORY", 2)
    run_incremental(lake, {"orders": lambda _: spread(spark, 40)}, "r", RUN)
    build(lake)
    for n in range(4):
        run_incremental(lake, {"orders": lambda _: spread(spark, 1, 50 + n)}, f"h{n}", NEXT)
    found = build(lake)
    assert build(lake, full=True) == found and count(lake, "analytics", "fact_orders") == 44
