import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from medallion.operators import sales
from medallion.operators.dedup import dedup_counts, drop_duplicates, keep_first, keep_last
from medallion.operators.quality import (
    QualityError, enforce, null_counts, quality_report, require_columns,
)
from tests.conftest import rows

RUN = datetime(2024, 6, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_last_an_unknown_time_wins(spark):
    df = spark.createDataFrame(
        [(1, 5, "old"), (1, 7, "new"), (2, None, "unknown"), (2, 9, "known"), (3, 1, "a"),
         (3, 1, "b")], "k int, t int, v string")
    assert rows(keep_last(df, ["k"], ["t"])) == [(1, 7, "new"), (2, None, "unknown"), (3, 1, "b")]
    assert rows(keep_first(df, ["k"], ["t"])) == [(1, 5, "old"), (2, 9, "known"), (3, 1, "a")]


def test_keep_last_is_idempotent_and_ignores_partitions(spark):
    rng = random.Random(3)
    data = [(rng.randrange(20), rng.choice([None, 1, 2, 3]), rng.randrange(9)) for _ in range(500)]
    df = spark.createDataFrame(data, "k int, t int, v int")
    once = rows(keep_last(df, ["k"], ["t"]))
    best = {}
    for k, t, v in data:
        rank = (t is None, t or 0, v)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, t, v))
    assert once == sorted((r for _, r in best.values()),
                          key=lambda r: tuple((v is None, str(v)) for v in r))
    assert rows(keep_last(keep_last(df, ["k"], ["t"]), ["k"], ["t"])) == once
    assert rows(keep_last(df.repartition(13), ["k"], ["t"])) == once


def test_keep_last_of_rows_without_an_order(spark):
    df = spark.createDataFrame([(1, 1, '{"a":1}'), (1, 2, '{"a":2}'), (2, 1, "[]")],
                               "k int, t int, j string").withColumn("j", F.parse_json("j"))
    last = drop_duplicates(df, ["k"], ["t", "absent"])
    assert rows(last.select("k", "t", F.to_json("j"))) == [(1, 2, '{"a":2}'), (2, 1, "[]")]


def test_keep_last_reduces_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = plan_of(keep_last(df, ["k"], ["id"]))
    assert "partial_max" in plan and "Window" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_keep_last_sends_few_rows_of_a_hot_key(spark):
    """A key with a third of all rows leaves at most one row per task."""
    df = spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    out = keep_last(df, ["k"], ["id"])
    assert out.count() == 60_001
    assert rows(out.where("k = -1")) == [(-1, 89_997)]


def test_dedup_counts(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1)], "a int, b int")
    assert rows(dedup_counts(df, ["a", "b"])) == [(4, 3)]
    assert rows(dedup_counts(df.limit(0), ["a"])) == [(0, 0)]


ORDERS = """SELECT * FROM VALUES
    (1, 10, 5.00, timestamp'2024-01-01 23:59:59', 'COMPLETED'),
    (2, 10, 7.50, timestamp'2024-01-01 00:00:00', 'CANCELLED'),
    (3, 11, NULL, timestamp'2024-01-01 12:00:00', 'COMPLETED'),
    (4, 12, 1.00, timestamp'2024-01-04 12:00:00', 'CANCELLED'),
    (5, 12, 9.00, NULL, 'COMPLETED')
    AS t(order_id, user_id, total, order_date, status)"""


def test_daily_sales(spark):
    assert rows(sales.daily_sales(spark.sql(ORDERS))) == [
        (date(2024, 1, 1), 3, 12.5, 6.25, 2), (date(2024, 1, 4), 1, 1.0, 1.0, 1),
        (None, 1, 9.0, 9.0, 1)]


def test_daily_sales_of_every_day(spark):
    found = sales.daily_sales_calendar(spark.sql(ORDERS), RUN).drop("_transformed_at")
    assert rows(found) == [
        (date(2024, 1, 1), 3, 12.5, 6.25, 2, 1, 33.33),
        (date(2024, 1, 2), 0, 0.0, None, 0, 0, None),
        (date(2024, 1, 3), 0, 0.0, None, 0, 0, None),
        (date(2024, 1, 4), 1, 1.0, 1.0, 1, 1, 100.0)]


def test_calendar_without_gap_days_equals_daily_sales(spark):
    orders = spark.sql(ORDERS).where("order_date IS NOT NULL")
    whole = sales.daily_sales_calendar(orders, RUN).where("order_count > 0")
    columns = ["sale_date", "order_count", "total_revenue_usd", "avg_order_value_usd",
               "unique_customers"]
    assert rows(whole.select(columns)) == rows(sales.daily_sales(orders).select(columns))


def test_calendar_edge_cases(spark):
    orders = spark.sql(ORDERS)
    with pytest.raises(ValueError, match="order_date"):
        sales.daily_sales_calendar(orders.drop("order_date"), RUN)
    plain = sales.daily_sales_calendar(orders.drop("status"), RUN)
    assert {r["cancelled_orders"] for r in plain.collect()} == {0}
    assert sales.daily_sales_calendar(orders.limit(0), RUN).count() == 0
    assert sales.daily_sales_calendar(orders.where("order_id = 4"), RUN).count() == 1


def test_distinct_customers_of_a_hot_day_are_counted_in_two_steps(spark):
    plan = plan_of(sales.daily_sales(spark.sql(ORDERS)))
    assert "partial_count(distinct user_id" in plan
    assert "Expand" not in plan


def test_gate(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (None, None)], "user_id int, email string")
    assert rows(null_counts(df, ["user_id", "email"])) == [(1, 2)]
    assert rows(quality_report(df, "users", ["user_id", "email", "tier"])) == [
        ("users", "email", 3, 2, "NULLS"), ("users", "tier", 3, None, "MISSING"),
        ("users", "user_id", 3, 1, "NULLS")]
    assert rows(quality_report(df.limit(0), "users", ["email"])) == [
        ("users", "email", 0, 0, "EMPTY")]
    with pytest.raises(QualityError, match="tier"):
        require_columns(df, "users", ["tier"])
    with pytest.raises(QualityError, match="no rows"):
        enforce({"rows": 0, "nulls_email": 0}, "users", ["email"])
    with pytest.raises(QualityError, match="email"):
        enforce({"rows": 3, "nulls_email": 2}, "users", ["email"])
    enforce({"rows": 3, "nulls_email": 0}, "users", ["email"])


def sold(spark, seed, n=600):
    rng = random.Random(seed)
    data = [(i, rng.choice([None, -7, -1, 0, 5, 32_767, 32_768, 10**9, rng.randrange(40), rng.randrange(10**6)]),
             rng.choice([None, "1.10", "2.25", "-3.00"]),
             rng.choice([None, *[datetime(2024, rng.randint(1, 3), rng.randint(1, 28), 12) for _ in range(9)]]))
            for i in range(n)]
    df = spark.createDataFrame(data, "order_id bigint, user_id bigint, total string, order_date timestamp")
    return df.withColumn("total", F.col("total").cast("decimal(10,2)"))


@pytest.mark.parametrize("seed", range(3))
def test_states_of_days_give_the_sales_of_any_span(spark, seed):
    orders = sold(spark, seed)
    names = ["order_count", "total_revenue_usd", "avg_order_value_usd", "unique_customers"]
    states = sales.day_states(orders)
    by_day = sales.merged_sales(states, F.col("sale_date")).select("span", *names)
    assert rows(by_day) == rows(sales.daily_sales(orders).select("sale_date", *names))
    for unit in ("week", "month", "year"):
        merged = sales.merged_sales(states, F.date_trunc(unit, "sale_date")).select(F.to_date("span"), *names)
        whole = orders.withColumn("order_date", F.date_trunc(unit, "order_date"))
        assert rows(merged) == rows(sales.daily_sales(whole).select("sale_date", *names))


def test_states_of_days_of_no_orders_and_of_nameless_ones(spark):
    none = sold(spark, 0).limit(0)
    assert sales.merged_sales(sales.day_states(none), F.col("sale_date")).count() == 0
    nameless = sold(spark, 0).where("user_id is null")
    assert rows(sales.merged_sales(sales.day_states(nameless), F.lit(1)).select("unique_customers")) == [(0,)]


def test_states_are_built_before_the_shuffle(spark):
    plan = plan_of(sales.day_states(sold(spark, 0)))
    assert "partial_bitmap_construct_agg" in plan and plan.count("Exchange") == 1
