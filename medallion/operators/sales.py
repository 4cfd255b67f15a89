"""Daily sales."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.contracts import CANCELLED, DEFAULT_ORDER_STATUS
from medallion.functions.numbers import percent
from medallion.functions.times import day, instant, to_utc

MONEY = "decimal(12,2)"


def _revenue() -> Column:
    """Exact sum: the result does not depend on the order of the rows."""
    return F.sum(F.col("total").cast(MONEY)).cast("double")


def daily_sales(orders: DataFrame) -> DataFrame:
    """One row per UTC day; orders without a date form a group of their own."""
    return (
        orders.groupBy(day(F.col("order_date")).alias("sale_date"))
        .agg(
            F.count("order_id").alias("order_count"),
            _revenue().alias("total_revenue_usd"),
            (_revenue() / F.nullif(F.count("total"), F.lit(0))).alias("avg_order_value_usd"),
            F.countDistinct("user_id").alias("unique_customers"),
        )
    )


def day_states(orders: DataFrame) -> DataFrame:
    """Sums of each day that can be merged to any longer span: ``sale_date, slot, order_count, priced, revenue,
    customers``.

    ``customers`` is a bitmap of the customer numbers (``user_id``, whole numbers) of one slot of 32,768, so distinct
    customers of several days are counted exactly, without a look at their orders.  A slot holds 4 KB at most
    whatever a day sells, and is built beside the scan, so a busy day sends as many rows as it has slots.  Orders
    without a customer are in a slot of their own, null.
    """
    return orders.groupBy(day(F.col("order_date")).alias("sale_date"), F.call_function("bitmap_bucket_number", "user_id").alias("slot")).agg(
        F.count("order_id").alias("order_count"), F.count("total").alias("priced"),
        F.sum(F.col("total").cast(MONEY)).alias("revenue"),
        F.call_function("bitmap_construct_agg", F.call_function("bitmap_bit_position", "user_id")).alias("customers"))


def merged_sales(states: DataFrame, span: Column) -> DataFrame:
    """Sales of spans of days, such as ``date_trunc('month', sale_date)``, from the states of their days: the columns of
    ``daily_sales`` with ``span`` for the day."""
    slots = states.groupBy(span.alias("span"), "slot").agg(
        F.sum("order_count").alias("order_count"), F.sum("priced").alias("priced"), F.sum("revenue").alias("revenue"),
        F.bitmap_count(F.bitmap_or_agg("customers")).alias("customers"))
    revenue = F.sum("revenue").cast("double")
    return slots.groupBy("span").agg(
        F.sum("order_count").alias("order_count"), revenue.alias("total_revenue_usd"),
        (revenue / F.nullif(F.sum("priced"), F.lit(0))).alias("avg_order_value_usd"),
        F.coalesce(F.sum(F.when(F.col("slot").isNotNull(), F.col("customers"))), F.lit(0)).alias("unique_customers"))


def cancelled_by_day(orders: DataFrame) -> DataFrame:
    return orders.groupBy(day(F.col("order_date")).alias("sale_date")).agg(
        F.count_if(F.col("status") == CANCELLED).alias("cancelled_orders")
    )


def cancellation_rate(orders: DataFrame) -> DataFrame:
    return orders.groupBy(day(F.col("order_date")).alias("sale_date")).agg(
        F.count("order_id").alias("order_count"),
        percent(F.count_if(F.col("status") == CANCELLED), F.count("order_id"))
        .alias("cancellation_rate_pct"),
    )


def daily_sales_calendar(orders: DataFrame, run_ts: datetime) -> DataFrame:
    """Daily sales for every day from the first to the last, sold or not.

    The first and last day come from a scan of the date column alone; the
    calendar has one row per day, and so has the aggregate it is joined to.
    """
    if "order_date" not in orders.columns:
        raise ValueError("daily sales need the column order_date")
    dated = orders.withColumn(
        "order_date", to_utc(F.col("order_date"), orders.schema["order_date"].dataType)
    ).where(F.col("order_date").isNotNull())
    if "status" not in dated.columns:
        dated = dated.withColumn("status", F.lit(DEFAULT_ORDER_STATUS))

    sold = dated.groupBy(day(F.col("order_date")).alias("sale_date")).agg(
        F.count("order_id").alias("order_count"),
        _revenue().alias("total_revenue_usd"),
        (_revenue() / F.nullif(F.count("total"), F.lit(0))).alias("avg_order_value_usd"),
        F.countDistinct("user_id").alias("unique_customers"),
        F.count_if(F.col("status") == CANCELLED).alias("cancelled_orders"),
    )
    span = dated.agg(
        day(F.min("order_date")).alias("first"), day(F.max("order_date")).alias("last")
    )
    calendar = span.select(F.explode(F.sequence("first", "last")).alias("sale_date"))
    zero = {"order_count": 0, "total_revenue_usd": 0.0, "unique_customers": 0,
            "cancelled_orders": 0}
    filled = calendar.join(sold, "sale_date", "left").fillna(zero)
    return filled.withColumns({
        "cancellation_rate_pct": percent(F.col("cancelled_orders"), F.col("order_count")),
        "_transformed_at": instant(run_ts),
    })
