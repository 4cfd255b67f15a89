"""Sample orders.

All draws are slices of an MD5 digest of (id, line), so the rows depend on
the ids alone: not on partitions, retries or the order of evaluation.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.functions.times import instant

# Ranges of the draws.
USERS = 100
PRODUCTS = 100
MAX_LINES = 5
MAX_QUANTITY = 3
PRICE_CENTS = (1_000, 50_000)
MAX_DISCOUNT_PCT = 30
MAX_AGE_DAYS = 365
MAX_UPDATE_HOURS = 24
ORDER_DISCOUNT = 0.95


def _draw(digest: Column, slot: int, low: int, high: int) -> Column:
    """Integer in [low, high] from the slot-th four hex digits of a digest."""
    value = F.conv(F.substring(digest, 4 * slot + 1, 4), 16, 10).cast("bigint")
    return value % (high - low + 1) + low


def _draws(digest: Column) -> Column:
    return F.struct(
        _draw(digest, 0, 1, PRODUCTS).alias("product"),
        _draw(digest, 1, 1, MAX_QUANTITY).alias("quantity"),
        _draw(digest, 2, *PRICE_CENTS).alias("cents"),
        _draw(digest, 3, 0, MAX_DISCOUNT_PCT).alias("discount"),
    )


def _line(drawn: Column) -> Column:
    product, quantity = drawn["product"], drawn["quantity"]
    cents, discount = drawn["cents"], drawn["discount"]
    # Half a cent rounds up, in whole numbers.
    total_cents = F.floor((cents * quantity * (100 - discount) + 50) / 100)
    unit_cents = F.floor((cents * (100 - discount) + 50) / 100)
    return F.struct(
        product.alias("id"),
        F.concat(F.lit("Product "), product.cast("string")).alias("title"),
        (cents / 100).alias("price"),
        quantity.cast("int").alias("quantity"),
        (total_cents / 100).alias("total"),
        discount.cast("double").alias("discountPercentage"),
        (unit_cents / 100).alias("discountedPrice"),
    )


def generate_orders(ids: DataFrame, today: datetime, seed: str = "orders") -> DataFrame:
    """One order per row of ``ids`` (column ``id``), as the source would hold it.

    The lines are written out one by one and not mapped over a sequence, so
    that all of it is compiled; sums run over cents.
    """
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.col("id").cast("string")))
    orders = ids.select("id", digest.alias("_digest"))
    orders = orders.withColumn("_n", _draw(F.col("_digest"), 0, 1, MAX_LINES).cast("int"))
    lines = range(1, MAX_LINES + 1)
    orders = orders.withColumns({f"_d{n}": F.md5(F.concat_ws("|", "_digest", F.lit(str(n)))) for n in lines})
    orders = orders.withColumns({f"_l{n}": _line(_draws(F.col(f"_d{n}"))) for n in lines})

    def over_lines(value, zero):
        total = zero
        for n in lines:
            total += F.when(F.col("_n") >= n, value(F.col(f"_l{n}"))).otherwise(zero)
        return total

    cents = over_lines(lambda line: F.round(line["total"] * 100).cast("bigint"), F.lit(0).cast("bigint"))
    quantity = over_lines(lambda line: line["quantity"], F.lit(0))
    age = _draw(F.col("_digest"), 2, 0, MAX_AGE_DAYS).cast("int")
    delay = _draw(F.col("_digest"), 3, 0, MAX_UPDATE_HOURS).cast("int")
    created = instant(today) - F.make_dt_interval(age)
    orders = orders.withColumns({
        "products": F.slice(F.array(*[f"_l{n}" for n in lines]), F.lit(1), F.col("_n")),
        "total": (cents / 100).cast("decimal(10,2)"), "quantity": quantity})
    return orders.select(
        "id",
        _draw(F.col("_digest"), 1, 1, USERS).alias("user_id"),
        "products",
        "total",
        (F.col("total") * F.lit(str(ORDER_DISCOUNT)).cast("decimal(3,2)"))
        .cast("decimal(10,2)").alias("discounted_total"),
        F.col("_n").alias("total_products"),
        F.col("quantity").alias("total_quantity"),
        created.alias("created_at"),
        (created + F.make_dt_interval(F.lit(0), delay)).alias("updated_at"),
    )
