"""Scans, projections, aggregates and entity transforms as frames."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.contracts import ORDER_SOURCE_COLUMNS
from medallion.operators import sales
from medallion.operators.dedup import dedup_counts as count_dedup
from medallion.operators.dedup import drop_duplicates, keep_last_by
from medallion.operators.quality import null_counts as count_nulls
from medallion.operators.quality import quality_report as report_quality
from medallion.plans import control, entities, warehouse
from medallion.sources import relational
from medallion.sources.generator import generate_orders
from workload.adapters import (
    MARK_LOG, ORDERS_SOURCE, PRODUCTS_SOURCE, RUN_LOG, USERS_SOURCE, mark_log, orders_source,
    products_source, run_log, table, users_source,
)
from workload.registry import RUN_1, query
from workload.twins import DAILY, ORDERS, PRODUCTS, USERS, columns, half_even, last_rows, number, ranked, \
    strip

MARK = datetime(1998, 6, 1)
MARK_SQL = "TIMESTAMP '1998-06-01 00:00:00'"


# --- relational source -----------------------------------------------------

_NINE = ORDER_SOURCE_COLUMNS.copy()
_NINE_SQL = columns(*["products_json" if c == "products" else c for c in _NINE])


def _with_json(df: DataFrame) -> DataFrame:
    return df.withColumn("products_json", F.to_json("products")).drop("products")


@query(f"WITH {ORDERS_SOURCE} SELECT {_NINE_SQL} FROM orders_source")
def scan_orders(spark: SparkSession, sf: str) -> DataFrame:
    return _with_json(relational.extract_orders(orders_source(spark, sf)))


@query(f"WITH {ORDERS_SOURCE} SELECT {_NINE_SQL} FROM orders_source WHERE updated_at > {MARK_SQL}")
def incremental_orders(spark: SparkSession, sf: str) -> DataFrame:
    return _with_json(relational.extract_orders(orders_source(spark, sf), watermark=MARK))


@query(f"WITH {ORDERS_SOURCE} SELECT id, created_at, updated_at FROM orders_source")
def typed_orders(spark: SparkSession, sf: str) -> DataFrame:
    text = orders_source(spark, sf).select(
        "id", F.col("created_at").cast("string"), F.col("updated_at").cast("string"))
    return relational.typed_times(text)


@query(f"WITH {ORDERS_SOURCE} SELECT id, user_id, updated_at FROM orders_source")
def orders_by_updated(spark: SparkSession, sf: str) -> DataFrame:
    rows = relational.by_update_time(orders_source(spark, sf).select("id", "user_id", "updated_at"))
    return rows


@query(f"""WITH {ORDERS_SOURCE} SELECT {_NINE_SQL} FROM orders_source
    WHERE updated_at > {MARK_SQL} ORDER BY updated_at, id LIMIT 500""")
def orders_limit(spark: SparkSession, sf: str) -> DataFrame:
    return _with_json(
        relational.extract_orders(orders_source(spark, sf), watermark=MARK, limit=500))


@query(f"""WITH {ORDERS_SOURCE} SELECT id, user_id, updated_at FROM orders_source
    ORDER BY updated_at, id LIMIT 10""")
def orders_head(spark: SparkSession, sf: str) -> DataFrame:
    return orders_by_updated.__wrapped__(spark, sf).limit(10)


@query(f"""WITH {ORDERS_SOURCE} SELECT count(*) AS total_orders, min(updated_at) AS first_update,
    max(updated_at) AS last_update FROM orders_source""")
def profile_orders(spark: SparkSession, sf: str) -> DataFrame:
    return relational.profile(orders_source(spark, sf))


_DRAW = "CAST('0x' || substr({d}, {a}, 4) AS BIGINT) % {n} + {low}"


def _draw(digest: str, slot: int, low: int, high: int) -> str:
    return _DRAW.format(d=digest, a=4 * slot + 1, n=high - low + 1, low=low)


@query(f"""WITH seeds AS (SELECT row_number() OVER () AS r, o_orderkey AS id,
        md5('orders|' || o_orderkey) AS d FROM orders),
    numbered AS (SELECT r, id, d, unnest(range(1, {_draw('d', 0, 1, 5)} + 1)) AS j FROM seeds),
    drawn AS (SELECT r, id, d, j, md5(d || '|' || j) AS e FROM numbered),
    lines AS (SELECT id, any_value(d) AS d, count(*) AS n, sum({_draw('e', 1, 1, 3)}) AS q,
        sum(CAST(((({_draw('e', 2, 1000, 50000)}) * ({_draw('e', 1, 1, 3)})
            * (100 - ({_draw('e', 3, 0, 30)})) + 50) // 100) AS DECIMAL(18,0))) / 100 AS total,
        string_agg(concat_ws('|', {_draw('e', 0, 1, 100)}, 'Product ' || ({_draw('e', 0, 1, 100)}),
            {_draw('e', 2, 1000, 50000)}, {_draw('e', 1, 1, 3)},
            ((({_draw('e', 2, 1000, 50000)}) * ({_draw('e', 1, 1, 3)})
                * (100 - ({_draw('e', 3, 0, 30)})) + 50) // 100),
            {_draw('e', 3, 0, 30)},
            ((({_draw('e', 2, 1000, 50000)}) * (100 - ({_draw('e', 3, 0, 30)})) + 50) // 100)),
            ';' ORDER BY j) AS items
        FROM drawn GROUP BY r, id)
    SELECT id, items, {_draw('d', 1, 1, 100)} AS user_id, CAST(total AS DOUBLE) AS total,
        CAST(CAST(CAST(total AS DECIMAL(10,2)) * CAST(0.95 AS DECIMAL(3,2)) AS DECIMAL(10,2))
             AS DOUBLE) AS discounted_total,
        CAST(n AS INT) AS total_products, CAST(q AS INT) AS total_quantity,
        TIMESTAMP '2024-06-01' - to_days(CAST({_draw('d', 2, 0, 365)} AS INT)) AS created_at,
        TIMESTAMP '2024-06-01' - to_days(CAST({_draw('d', 2, 0, 365)} AS INT))
            + to_hours({_draw('d', 3, 0, 24)}) AS updated_at
    FROM lines""")
def gen_orders(spark: SparkSession, sf: str) -> DataFrame:
    ids = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))
    def hundredths(p, name):
        return F.round(p[name] * 100).cast("bigint").cast("string")

    items = F.transform("products", lambda p: F.concat_ws(
        "|", p["id"].cast("string"), p["title"], hundredths(p, "price"), p["quantity"].cast("string"),
        hundredths(p, "total"), p["discountPercentage"].cast("int").cast("string"), hundredths(p, "discountedPrice")))
    return generate_orders(ids, RUN_1).withColumn("items", F.array_join(items, ";")).drop("products")


# --- projections and guards ------------------------------------------------


@query(f"WITH {ORDERS_SOURCE} SELECT id AS order_id, user_id, created_at AS order_date FROM orders_source")
def rename_orders(spark: SparkSession, sf: str) -> DataFrame:
    return entities.rename_orders(orders_source(spark, sf)).select(
        "order_id", "user_id", "order_date")


@query(f"""WITH {PRODUCTS_SOURCE} SELECT id, id AS product_id, title AS product_name,
    {number('discountPercentage')} AS discount_percentage,
    {number('discountedPrice')} AS discounted_price, {strip('returnPolicy')} AS return_policy,
    TRY_CAST(nullif(regexp_extract(warrantyInformation, '[0-9]+'), '') AS INT)
        AS warranty_months FROM products_source""")
def alias_products(spark: SparkSession, sf: str) -> DataFrame:
    return entities.alias_products(products_source(spark, sf)).select(
        "id", "product_id", "product_name", "discount_percentage", "discounted_price",
        "return_policy", "warranty_months")


@query(f"WITH {ORDERS} SELECT * FROM orders_enriched")
def align_orders(spark: SparkSession, sf: str) -> DataFrame:
    return entities.align_orders(entities.enrich_orders(orders_source(spark, sf), RUN_1))


@query(f"WITH {USERS} SELECT * FROM users_enriched")
def align_users(spark: SparkSession, sf: str) -> DataFrame:
    return entities.align_users(entities.enrich_users(users_source(spark, sf), RUN_1))


@query(f"WITH {PRODUCTS} SELECT * FROM products_enriched")
def align_products(spark: SparkSession, sf: str) -> DataFrame:
    return entities.align_products(entities.enrich_products(products_source(spark, sf), RUN_1))


@query(f"""WITH {USERS} SELECT user_id, email, username, password_masked, first_name, last_name,
    full_name, address_city, address_lat, phone_masked FROM users_enriched""")
def clean_users(spark: SparkSession, sf: str) -> DataFrame:
    clean = entities.clean_users(users_source(spark, sf))
    return clean.select("user_id", "email", "username", "password_masked", "first_name",
                        "last_name", "full_name", "address_city", "address_lat", "phone_masked")


@query("""SELECT o_orderkey AS id, TIMESTAMP '2024-06-01' AS _transformed_at,
    '1.0' AS _pipeline_version FROM orders""")
def audit_columns(spark: SparkSession, sf: str) -> DataFrame:
    return entities.audited(orders_source(spark, sf).select("id"), RUN_1)


_NULL_USER = "CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_custkey END AS user_id"


@query(f"""SELECT * FROM (SELECT o_orderkey AS order_id, {_NULL_USER}, o_totalprice FROM orders)
    WHERE order_id IS NOT NULL AND user_id IS NOT NULL""")
def required_orders(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").selectExpr("o_orderkey AS order_id", _NULL_USER, "o_totalprice")
    return entities.required(df, ("order_id", "user_id"))


@query(f"WITH {USERS_SOURCE} SELECT id AS user_id, email FROM users_source WHERE email IS NOT NULL")
def required_users(spark: SparkSession, sf: str) -> DataFrame:
    df = users_source(spark, sf).withColumnRenamed("id", "user_id").select("user_id", "email")
    return entities.required(df, ("user_id", "email"))


@query(f"""WITH {PRODUCTS_SOURCE} SELECT id AS product_id, title AS product_name
    FROM products_source WHERE title IS NOT NULL""")
def required_products(spark: SparkSession, sf: str) -> DataFrame:
    df = products_source(spark, sf).select(
        F.col("id").alias("product_id"), F.col("title").alias("product_name"))
    return entities.required(df, ("product_id", "product_name"))


# --- dedup -----------------------------------------------------------------

_LINE = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
         "l_tax", "l_returnflag", "l_linestatus"]


_CHANGES = "CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE l_shipdate END AS updated_at"


@query(f"""WITH changes AS (SELECT l_orderkey AS order_id, {_CHANGES}, {columns(*_LINE)}
    FROM lineitem) {ranked('changes', ['order_id'], ['updated_at'], _LINE)}""")
def dedup_orders(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem").selectExpr("l_orderkey AS order_id", _CHANGES, *_LINE)
    return drop_duplicates(df, ["order_id"], ["updated_at"])


@query(f"""WITH arrived AS (SELECT o_custkey AS user_id, o_orderkey // 100 + 1 AS _page,
        o_orderkey % 100 AS _pos, lower(o_orderpriority) || '@example.com' AS email FROM orders)
    {ranked('arrived', ['user_id'], ['_page', '_pos'], ['email'])}""")
def dedup_users(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").selectExpr(
        "o_custkey AS user_id", "o_orderkey div 100 + 1 AS _page", "o_orderkey % 100 AS _pos",
        "concat(lower(o_orderpriority), '@example.com') AS email")
    return drop_duplicates(df, ["user_id"], ["_page", "_pos"])


@query(f"""WITH arrived AS (SELECT l_partkey AS product_id, l_orderkey AS _page,
        l_linenumber AS _pos, l_extendedprice / l_quantity AS price, l_suppkey FROM lineitem)
    {ranked('arrived', ['product_id'], ['_page', '_pos'], ['price', 'l_suppkey'])}""")
def dedup_products(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem").selectExpr(
        "l_partkey AS product_id", "l_orderkey AS _page", "l_linenumber AS _pos",
        "l_extendedprice / l_quantity AS price", "l_suppkey")
    return drop_duplicates(df, ["product_id"], ["_page", "_pos"])


@query("""SELECT user_id, event_id, ts, CAST(props->>'$.k' AS BIGINT) AS k
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
          FROM events) WHERE rn = 1""")
def dedup_max_by(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").withColumn("props", F.try_parse_json("props"))
    last = keep_last_by(df, ["user_id"], ["ts", "event_id"])
    k = F.try_variant_get("props", "$.k", "bigint")
    return last.select("user_id", "event_id", "ts", k.alias("k"))


@query("""SELECT count(*) AS rows_before,
    (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS rows_after
    FROM lineitem""")
def dedup_counts(spark: SparkSession, sf: str) -> DataFrame:
    return count_dedup(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# --- entity transforms and layers ------------------------------------------


@query(f"WITH {ORDERS} SELECT * FROM orders_clean")
def transform_orders(spark: SparkSession, sf: str) -> DataFrame:
    return entities.transform_orders(orders_source(spark, sf), RUN_1)


@query(f"WITH {USERS} SELECT * FROM users_clean")
def transform_users(spark: SparkSession, sf: str) -> DataFrame:
    return entities.transform_users(users_source(spark, sf), RUN_1)


@query(f"WITH {PRODUCTS} SELECT * FROM products_clean")
def transform_products(spark: SparkSession, sf: str) -> DataFrame:
    return entities.transform_products(products_source(spark, sf), RUN_1)


@query(f"WITH {ORDERS} SELECT * FROM orders_clean")
def stg_orders(spark: SparkSession, sf: str) -> DataFrame:
    return warehouse.stg_orders(transform_orders.__wrapped__(spark, sf))


@query(f"WITH {USERS} SELECT * FROM users_clean")
def stg_users(spark: SparkSession, sf: str) -> DataFrame:
    return warehouse.stg_users(transform_users.__wrapped__(spark, sf))


@query(f"WITH {PRODUCTS} SELECT * EXCLUDE (id, thumbnail) FROM products_clean")
def stg_products(spark: SparkSession, sf: str) -> DataFrame:
    return warehouse.stg_products(transform_products.__wrapped__(spark, sf))


@query(f"""WITH {USERS} SELECT DISTINCT user_id, email, username, first_name, last_name, full_name,
    address_city, address_state, address_postal_code, sk_user FROM users_clean""")
def dim_customers(spark: SparkSession, sf: str) -> DataFrame:
    return warehouse.dim_customers(stg_users.__wrapped__(spark, sf))


@query(f"""WITH {PRODUCTS} SELECT DISTINCT product_id, product_name, price, category,
    discount_percentage, discounted_price, stock, warranty_months, sk_product
    FROM products_clean""")
def dim_products(spark: SparkSession, sf: str) -> DataFrame:
    return warehouse.dim_products(stg_products.__wrapped__(spark, sf))


@query(f"WITH {ORDERS} SELECT * EXCLUDE (_transformed_at, _pipeline_version) FROM orders_clean")
def fact_orders(spark: SparkSession, sf: str) -> DataFrame:
    return warehouse.fact_orders(stg_orders.__wrapped__(spark, sf))


# --- daily sales -----------------------------------------------------------


_SOLD = ["id", "user_id", "total", "created_at", "updated_at"]


@query(f"""WITH {ORDERS}, sold AS ({last_rows('orders_enriched', 'order_id',
    ['user_id', 'total', 'order_date'], ['updated_at'])}) {DAILY} FROM sold GROUP BY 1""")
def agg_daily_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Only the columns the sums need pass through the dedup."""
    clean = entities.transform_orders(orders_source(spark, sf).select(_SOLD), RUN_1)
    return sales.daily_sales(clean)


@query(f"""WITH {ORDERS_SOURCE}, spans AS (SELECT id AS order_id, date_trunc('month', created_at) AS order_date, total, user_id
    FROM orders_source) {DAILY} FROM spans GROUP BY 1""")
def monthly_sales_from_days(spark: SparkSession, sf: str) -> DataFrame:
    """Months merged from the states of their days; distinct customers are those of the orders."""
    states = sales.day_states(_dated(spark, sf))
    return sales.merged_sales(states, F.to_date(F.date_trunc("month", "sale_date"))).withColumnRenamed("span", "sale_date")


def _dated(spark: SparkSession, sf: str) -> DataFrame:
    return entities.rename_orders(orders_source(spark, sf))


_BY_DAY = f"""{ORDERS_SOURCE}, dated AS (
    SELECT id AS order_id, created_at AS order_date, total, user_id, status FROM orders_source)"""


@query(f"""WITH {_BY_DAY},
    sold AS ({DAILY}, count(*) FILTER (status = 'CANCELLED') AS cancelled_orders
             FROM dated GROUP BY 1),
    calendar AS (SELECT CAST(unnest(generate_series(min(sale_date), max(sale_date),
                 INTERVAL 1 DAY)) AS DATE) AS sale_date FROM sold)
    SELECT sale_date, coalesce(order_count, 0) AS order_count,
        coalesce(total_revenue_usd, 0) AS total_revenue_usd, avg_order_value_usd,
        coalesce(unique_customers, 0) AS unique_customers,
        coalesce(cancelled_orders, 0) AS cancelled_orders,
        {half_even('cancelled_orders / nullif(order_count, 0) * 100')} AS cancellation_rate_pct,
        TIMESTAMP '2024-06-01' AS _transformed_at
    FROM calendar LEFT JOIN sold USING (sale_date)""")
def daily_sales_gapfilled(spark: SparkSession, sf: str) -> DataFrame:
    return sales.daily_sales_calendar(_dated(spark, sf), RUN_1)


@query(f"""WITH {_BY_DAY} SELECT CAST(order_date AS DATE) AS sale_date,
    count(*) FILTER (status = 'CANCELLED') AS cancelled_orders FROM dated GROUP BY 1""")
def cancelled_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return sales.cancelled_by_day(_dated(spark, sf))


@query(f"""WITH {_BY_DAY} SELECT CAST(order_date AS DATE) AS sale_date, count(*) AS order_count,
    {half_even("count(*) FILTER (status = 'CANCELLED') / count(*) * 100")}
    AS cancellation_rate_pct FROM dated GROUP BY 1""")
def cancellation_rate(spark: SparkSession, sf: str) -> DataFrame:
    return sales.cancellation_rate(_dated(spark, sf))


# --- order lines -----------------------------------------------------------


@query("""SELECT o_orderkey AS order_id, CAST(j AS INT) AS line,
        (o_custkey + 7 * j) % 100 + 1 AS product_id,
        'Product ' || ((o_custkey + 7 * j) % 100 + 1) AS title,
        ((o_orderkey * 31 + j * 17) % 49000 + 1000) / 100 AS price,
        CAST((o_orderkey + j) % 3 + 1 AS INT) AS quantity,
        ((o_orderkey * 31 + j * 17) % 49000 + 1000) * ((o_orderkey + j) % 3 + 1) / 100
            AS line_total,
        CAST((o_orderkey + 3 * j) % 31 AS DOUBLE) AS discount_percentage,
        ((o_orderkey * 31 + j * 17) % 49000 + 1000) * (100 - (o_orderkey + 3 * j) % 31) / 10000
            AS discounted_price
    FROM (SELECT *, unnest(range(1, o_orderkey % 5 + 2)) AS j FROM orders)""")
def explode_order_lines(spark: SparkSession, sf: str) -> DataFrame:
    return entities.order_lines(entities.enrich_orders(orders_source(spark, sf), RUN_1))


@query(f"""WITH {ORDERS} SELECT order_id, discounted_total AS order_value,
    total - discounted_total AS discount_amount,
    total / nullif(total_products, 0) AS avg_product_value FROM orders_enriched""")
def order_metrics(spark: SparkSession, sf: str) -> DataFrame:
    clean = entities.enrich_orders(orders_source(spark, sf), RUN_1)
    return entities.order_metrics(clean).select(
        "order_id", "order_value", "discount_amount", "avg_product_value")


# --- quality and control ---------------------------------------------------


@query(f"""WITH {USERS_SOURCE} SELECT count(*) FILTER (id IS NULL) AS id,
    count(*) FILTER (email IS NULL) AS email, count(*) FILTER (password IS NULL) AS password,
    count(*) FILTER (firstName IS NULL) AS "firstName" FROM users_source""")
def null_counts(spark: SparkSession, sf: str) -> DataFrame:
    return count_nulls(users_source(spark, sf), ["id", "email", "password", "firstName"])


@query(f"""WITH {USERS_SOURCE}, totals AS (SELECT count(*) AS n,
        count(*) FILTER (id IS NULL) AS a, count(*) FILTER (email IS NULL) AS b FROM users_source)
    SELECT 'users' AS dataset, 'id' AS column_name, n AS row_count, a AS null_count,
        'PASSED' AS status FROM totals
    UNION ALL SELECT 'users', 'email', n, b, 'NULLS' FROM totals
    UNION ALL SELECT 'users', 'tier', n, NULL, 'MISSING' FROM totals""")
def quality_report(spark: SparkSession, sf: str) -> DataFrame:
    return report_quality(users_source(spark, sf), "users", ["id", "email", "tier"])


@query(f"""WITH {MARK_LOG} SELECT pipeline_name, max(watermark_value) AS watermark_value
    FROM mark_log WHERE status = 'SUCCESS' GROUP BY 1""")
def get_watermark(spark: SparkSession, sf: str) -> DataFrame:
    return control.latest_watermarks(mark_log(spark, sf))


@query("""SELECT coalesce(max(CASE WHEN o_orderdate IS NULL THEN o_orderdate END),
    max(o_orderdate)) AS next_watermark FROM orders""")
def next_watermark(spark: SparkSession, sf: str) -> DataFrame:
    # The first candidate has no value in any row, so the second one counts.
    df = orders_source(spark, sf).withColumn("updated_at", F.lit(None).cast("timestamp"))
    return control.next_watermark(df, ("updated_at", "created_at", "_extracted_at"))


@query(f"WITH {RUN_LOG} SELECT run_id, sum(rows_loaded) AS rows_loaded FROM run_log GROUP BY 1")
def rows_loaded_by_run(spark: SparkSession, sf: str) -> DataFrame:
    return control.rows_loaded_by_run(run_log(spark, sf))


_COUNTS = "CASE WHEN event_id % 50 = 0 THEN -1 WHEN user_id < 75 THEN 0 ELSE user_id END"


@query(f"""WITH counts AS (SELECT event_type || '_' || strftime(ts, '%Y%m%d%H') AS run_id,
        {_COUNTS} AS rows_loaded FROM events)
    SELECT run_id, sum(rows_loaded) AS rows_loaded, CASE WHEN min(rows_loaded) < 0 THEN 'INVALID'
        WHEN sum(rows_loaded) = 0 THEN 'NO_ROWS' ELSE 'PASSED' END AS status
    FROM counts GROUP BY 1""")
def incremental_gate(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "events").selectExpr(
        "concat(event_type, '_', date_format(ts, 'yyyyMMddHH')) AS run_id",
        f"{_COUNTS} AS rows_loaded")
    return control.incremental_gate_report(counts)
