"""Column functions over whole tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.functions import nested, numbers, text, times
from medallion.functions.keys import surrogate_key
from medallion.plans.entities import apply_rules, clean_products, default_status, flatten_address, \
    flatten_name, in_place, split_name
from workload.adapters import (
    ORDERS_SOURCE, PRODUCTS_SOURCE, USERS_SOURCE, orders_source, products_source, table,
    users_source,
)
from workload.registry import query
from workload.twins import REVIEWS, half_even, key, number, strip


def _key(df: DataFrame, prefix: str, alias: str) -> DataFrame:
    return df.select("id", surrogate_key(prefix, F.col("id"), df.schema["id"].dataType).alias(alias))


@query(f"SELECT o_orderkey AS id, {key('order', 'o_orderkey')} AS sk_order FROM orders")
def sk_orders(spark: SparkSession, sf: str) -> DataFrame:
    return _key(orders_source(spark, sf), "order", "sk_order")


@query(f"SELECT c_custkey AS id, {key('user', 'c_custkey')} AS sk_user FROM customer")
def sk_users(spark: SparkSession, sf: str) -> DataFrame:
    return _key(users_source(spark, sf), "user", "sk_user")


@query(f"SELECT p_partkey AS id, {key('product', 'p_partkey')} AS sk_product FROM part")
def sk_products(spark: SparkSession, sf: str) -> DataFrame:
    return _key(products_source(spark, sf), "product", "sk_product")


@query(f"WITH {USERS_SOURCE} SELECT id, lower({strip('email')}) AS email FROM users_source")
def norm_email(spark: SparkSession, sf: str) -> DataFrame:
    return users_source(spark, sf).select("id", text.normal_email(F.col("email")).alias("email"))


@query(f"""WITH {PRODUCTS_SOURCE} SELECT id, upper({strip('category')}) AS category,
    upper({strip('brand')}) AS brand FROM products_source""")
def strip_upper(spark: SparkSession, sf: str) -> DataFrame:
    return products_source(spark, sf).select(
        "id", *[text.strip_upper(F.col(c)).alias(c) for c in ("category", "brand")])


@query(f"""WITH {USERS_SOURCE} SELECT id, {strip('username')} AS username,
    {strip('firstName')} AS first_name FROM users_source""")
def strip_text(spark: SparkSession, sf: str) -> DataFrame:
    return users_source(spark, sf).select(
        "id", text.strip(F.col("username")).alias("username"),
        text.strip(F.col("firstName")).alias("first_name"))


@query(f"""WITH {USERS_SOURCE} SELECT id, trim(coalesce({strip('firstName')}, '') || ' '
    || coalesce({strip('lastName')}, '')) AS full_name FROM users_source""")
def full_name(spark: SparkSession, sf: str) -> DataFrame:
    return split_name(users_source(spark, sf)).select("id", "full_name")


@query(f"""WITH {USERS_SOURCE} SELECT id, regexp_replace(password, '[^\\n]', '*', 'g')
    AS password_masked FROM users_source""")
def mask_password(spark: SparkSession, sf: str) -> DataFrame:
    return users_source(spark, sf).select(
        "id", text.mask_all(F.col("password")).alias("password_masked"))


@query(f"""WITH {USERS_SOURCE} SELECT id, CASE WHEN phone LIKE '+%' THEN phone ELSE
    repeat('*', length(phone) - 4) || right(phone, 4) END AS phone_masked FROM users_source""")
def mask_phone(spark: SparkSession, sf: str) -> DataFrame:
    return users_source(spark, sf).select(
        "id", text.mask_phone(F.col("phone")).alias("phone_masked"))


@query(f"""WITH {PRODUCTS_SOURCE} SELECT id, {number('rating')} AS rating,
    {number('discountPercentage')} AS discount_percentage,
    {number('discountedPrice')} AS discounted_price FROM products_source""")
def to_number(spark: SparkSession, sf: str) -> DataFrame:
    df = products_source(spark, sf)
    new = {"rating": "rating", "discount_percentage": "discountPercentage",
           "discounted_price": "discountedPrice"}
    return df.select("id", *[
        numbers.to_number(F.col(c), df.schema[c].dataType).alias(n) for n, c in new.items()])


_DIRTY_TOTAL = """CASE WHEN o_orderkey % 13 = 0 THEN 'n/a' WHEN o_orderkey % 11 = 0 THEN NULL
    WHEN o_orderkey % 7 = 0 THEN concat('-', o_custkey, '.5 ')
    ELSE concat(' ', o_custkey, '.25') END"""


@query(f"""WITH dirty AS (SELECT o_orderkey AS id, {_DIRTY_TOTAL} AS total FROM orders)
    SELECT id, greatest(coalesce({number('total')}, 0), 0) AS total FROM dirty""")
def clean_money(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").selectExpr("o_orderkey AS id", f"{_DIRTY_TOTAL} AS total")
    return df.select(
        "id", numbers.clean_money(F.col("total"), df.schema["total"].dataType).alias("total"))


@query(f"""WITH {PRODUCTS_SOURCE} SELECT id,
    CAST(CASE WHEN price < 0 THEN 0 ELSE price END AS DOUBLE) AS price FROM products_source""")
def clip_price(spark: SparkSession, sf: str) -> DataFrame:
    df = products_source(spark, sf)
    return df.select(
        "id", numbers.clip_price(F.col("price"), df.schema["price"].dataType).alias("price"))


_MARGIN = half_even("(price - cost) / nullif(price, 0) * 100")


@query(f"""WITH {PRODUCTS_SOURCE}, clipped AS (SELECT id, CAST(cost AS DOUBLE) AS cost,
    CAST(CASE WHEN price < 0 THEN 0 ELSE price END AS DOUBLE) AS price FROM products_source)
    SELECT id, {_MARGIN} AS margin_pct FROM clipped""")
def margin_pct(spark: SparkSession, sf: str) -> DataFrame:
    df = products_source(spark, sf)
    price = numbers.clip_price(F.col("price"), df.schema["price"].dataType)
    return df.select("id", numbers.margin_pct(price, F.col("cost")).alias("margin_pct"))


_TIME_TEXT = """CASE WHEN event_id % 10 = 0 THEN 'soon' WHEN event_id % 10 = 1 THEN NULL
    ELSE CAST(ts AS {text}) END"""


@query(f"""SELECT event_id, CASE WHEN event_id % 10 > 1 THEN ts END AS updated_at,
    ts AS created_at FROM events""", name="cast_timestamps")
def cast_timestamps_events(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").selectExpr(
        "event_id", f"{_TIME_TEXT.format(text='string')} AS updated_at", "ts AS created_at")
    return apply_rules(df, in_place(times.to_utc, "updated_at", "created_at", "absent"))


@query("""SELECT o_orderkey AS id, year(o_orderdate) AS order_year,
    month(o_orderdate) AS order_month, isodow(o_orderdate) - 1 AS order_day_of_week FROM orders""")
def date_parts(spark: SparkSession, sf: str) -> DataFrame:
    parts = times.date_parts(F.col("created_at"), "order")
    return orders_source(spark, sf).select("id", *[c.alias(n) for n, c in parts.items()])


@query(f"""WITH {PRODUCTS_SOURCE} SELECT id,
    TRY_CAST(nullif(regexp_extract(warrantyInformation, '[0-9]+'), '') AS INT)
    AS warranty_months FROM products_source""")
def warranty_months(spark: SparkSession, sf: str) -> DataFrame:
    return products_source(spark, sf).select(
        "id", numbers.first_integer(F.col("warrantyInformation")).alias("warranty_months"))


@query(f"""WITH {PRODUCTS_SOURCE}
    SELECT id, CAST({REVIEWS} AS INT) AS reviews FROM products_source""")
def review_count(spark: SparkSession, sf: str) -> DataFrame:
    df = products_source(spark, sf)
    return df.select(
        "id", nested.review_count(F.col("reviews"), df.schema["reviews"].dataType).alias("reviews"))


@query(f"WITH {ORDERS_SOURCE} SELECT id, products_json FROM orders_source")
def products_json(spark: SparkSession, sf: str) -> DataFrame:
    df = orders_source(spark, sf)
    json = nested.json_text(F.col("products"), df.schema["products"].dataType)
    return df.select("id", json.alias("products_json"))


@query(f"WITH {PRODUCTS_SOURCE} SELECT id, dimensions AS dimensions_json FROM products_source")
def dimensions_json(spark: SparkSession, sf: str) -> DataFrame:
    df = products_source(spark, sf)
    json = nested.json_text(F.col("dimensions"), df.schema["dimensions"].dataType)
    return df.select("id", json.alias("dimensions_json"))


@query("SELECT p_partkey AS id, 'ACTIVE' AS status FROM part", name="default_status")
def default_status_products(spark: SparkSession, sf: str) -> DataFrame:
    return default_status(products_source(spark, sf), "ACTIVE").select("id", "status")


_STATUS = """CASE WHEN p_size % 3 = 0 THEN ' active ' WHEN p_size % 3 = 1 THEN 'retired' END"""


@query(f"""SELECT p_partkey AS id, upper(trim({_STATUS})) AS status,
    upper(trim({_STATUS})) = 'ACTIVE' AS is_active FROM part WHERE p_name IS NOT NULL""")
def is_active(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "part").selectExpr("p_partkey AS id", "p_name AS title", f"{_STATUS} AS status")
    return clean_products(df).select("id", "status", "is_active")


@query("""SELECT event_id, CASE WHEN event_id % 17 <> 0
    THEN CAST((event_id % 7919) AS DOUBLE) / 100 END AS duration_seconds FROM events""")
def run_duration(spark: SparkSession, sf: str) -> DataFrame:
    # Ends lie a whole number of hundredths and three milliseconds after the start.
    start = F.when(F.col("event_id") % 17 != 0, F.col("ts"))
    spent = F.col("event_id") % 7919 * 10 + 3
    end = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + spent * 1000)
    return table(spark, sf, "events").select(
        "event_id", times.elapsed_seconds(start, end).alias("duration_seconds"))


@query("""SELECT event_id, length(substr(e, 1, 5000)) AS n, md5(substr(e, 1, 5000)) AS digest
    FROM (SELECT event_id, repeat(props || event_id, CAST(event_id % 600 AS INT)) AS e
          FROM events)""")
def truncate_error(spark: SparkSession, sf: str) -> DataFrame:
    error = F.expr("repeat(concat(props, event_id), CAST(event_id % 600 AS int))")
    cut = table(spark, sf, "events").select("event_id", text.cut_error(error).alias("e"))
    return cut.select("event_id", F.length("e").alias("n"), F.md5("e").alias("digest"))


@query(f"""WITH {USERS_SOURCE} SELECT id, address_line1, address_city, address_state,
    address_postal_code, address_lat, address_lng FROM users_source""", name="flatten_address")
def flatten_address_users(spark: SparkSession, sf: str) -> DataFrame:
    return flatten_address(users_source(spark, sf).select("id", "address"))


@query(f"""WITH {USERS_SOURCE} SELECT id, firstName AS first_name, lastName AS last_name,
    trim(coalesce(firstName, '') || ' ' || coalesce(lastName, ''), ' ' || chr(9)) AS full_name
    FROM users_source""", name="flatten_name")
def flatten_name_users(spark: SparkSession, sf: str) -> DataFrame:
    name = F.struct(F.col("firstName").alias("firstname"), F.col("lastName").alias("lastname"))
    return flatten_name(users_source(spark, sf).select("id", name.alias("name")))
