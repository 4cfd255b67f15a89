"""Staging and analytics layers, built from the layer beneath.

A build follows the history of its source: partitions that no load has touched
since the last build stay as and where they are, days in them are not summed
again, and a table whose source has not changed is not written at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion import contracts
from medallion.operators.lake import NO_DATE, PART, Lake, parts_of, refresh
from medallion.operators.sales import daily_sales


def stg_users(raw: DataFrame) -> DataFrame:
    return raw.select(*contracts.STG_USER_COLUMNS)


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.select(*contracts.STG_PRODUCT_COLUMNS)


def stg_orders(raw: DataFrame) -> DataFrame:
    return raw.select(*contracts.STG_ORDER_COLUMNS)


def dim_customers(stg: DataFrame) -> DataFrame:
    return stg.select(*contracts.DIM_CUSTOMER_COLUMNS).distinct()


def dim_products(stg: DataFrame) -> DataFrame:
    return stg.select(*contracts.DIM_PRODUCT_COLUMNS).distinct()


def fact_orders(stg: DataFrame) -> DataFrame:
    return stg.select(*contracts.FACT_ORDER_COLUMNS)


def build_staging(lake: Lake, full: bool = False) -> None:
    """Copies of raw columns.  Partitions are taken over, so nothing is
    shuffled; orders are sorted by date inside the files, so that a filter on
    days reads few row groups.  ``full`` copies untouched partitions too."""
    for entity, table, columns in (
        (contracts.USERS, "stg_users", contracts.STG_USER_COLUMNS),
        (contracts.PRODUCTS, "stg_products", contracts.STG_PRODUCT_COLUMNS),
        (contracts.ORDERS, "stg_orders", contracts.STG_ORDER_COLUMNS),
    ):
        def rows(touched: list[str] | None, entity=entity, columns=columns) -> DataFrame:
            found = parts_of(lake.spark.table(lake.raw(entity)), touched).select(*columns, PART)
            return by_day(found) if entity.date_key else found

        refresh(lake, lake.raw_place(entity), "staging", table, rows, full)


def by_day(rows: DataFrame) -> DataFrame:
    return rows.sortWithinPartitions(PART, "order_date")


def sales_of(lake: Lake, touched: list[str] | None) -> DataFrame:
    """Daily sales: days of touched partitions from their orders, the others as they are.

    A day's orders lie in one partition.  There is one row for each day, so the full sort is a small one.
    """
    orders = lake.spark.table(lake.name("staging", "stg_orders"))
    found = daily_sales(parts_of(orders, touched))
    if touched is not None:
        part = F.coalesce(F.date_format("sale_date", lake.period), F.lit(NO_DATE))
        known = lake.table("analytics", "agg_daily_sales").where(~part.isin(touched))
        found = found.unionByName(known.select(*found.columns))
    return found.orderBy("sale_date")


def build_analytics(lake: Lake, full: bool = False) -> None:
    """Dimensions are distinct over all rows of their source, so they are built whole when it has changed."""
    def stg(table: str) -> DataFrame:
        return lake.spark.table(lake.name("staging", table))

    def facts(touched: list[str] | None) -> DataFrame:
        return by_day(parts_of(stg("stg_orders"), touched).select(*contracts.FACT_ORDER_COLUMNS, PART))

    for source, table, rows, cluster_by in (
        ("stg_users", "dim_customers", lambda _: dim_customers(stg("stg_users")), ["user_id"]),
        ("stg_products", "dim_products", lambda _: dim_products(stg("stg_products")), ["product_id", "category"]),
        ("stg_orders", "fact_orders", facts, None),
        ("stg_orders", "agg_daily_sales", lambda touched: sales_of(lake, touched), None),
    ):
        refresh(lake, lake.place("staging", source), "analytics", table, rows, full, cluster_by)
