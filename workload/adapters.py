"""Source-shaped frames out of the given tables, and the same as SQL.

The given tables hold no nulls or malformed values; those are put in by key
arithmetic, alike on both sides.  Every value depends on its own row only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.operators.dedup import keep_last
from medallion.sources.pages import PAGE_SIZE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- orders ----------------------------------------------------------------

MAX_ITEMS = 5


def _item(j: int) -> str:
    cents = f"((o_orderkey * 31 + {j * 17}) % 49000 + 1000)"
    product = f"(o_custkey + {7 * j}) % 100 + 1"
    discount = f"(o_orderkey + {3 * j}) % 31"
    return f"""named_struct(
        'id', {product}, 'title', concat('Product ', {product}),
        'price', {cents} / 100, 'quantity', CAST({_quantity(j)} AS int),
        'total', {cents} * ({_quantity(j)}) / 100,
        'discountPercentage', CAST({discount} AS double),
        'discountedPrice', {cents} * (100 - {discount}) / 10000)"""


def _quantity(j: int) -> str:
    return f"(o_orderkey + {j}) % 3 + 1"


# Written out item by item: unlike a lambda, this is compiled with the rest.
_ITEMS = ", ".join(_item(j) for j in range(1, MAX_ITEMS + 1))
_QUANTITIES = " + ".join(f"IF(o_orderkey % {MAX_ITEMS} + 1 >= {j}, {_quantity(j)}, 0)"
                         for j in range(1, MAX_ITEMS + 1))


def orders_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as their database holds them: one to five items each, every
    seventh total negative, every thirteenth unknown."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id",
        "o_custkey AS user_id",
        f"slice(array({_ITEMS}), 1, CAST(o_orderkey % 5 + 1 AS int)) AS products",
        """CAST(CASE WHEN o_orderkey % 13 = 0 THEN NULL
                     WHEN o_orderkey % 7 = 0 THEN -o_totalprice
                     ELSE o_totalprice END AS decimal(10,2)) AS total""",
        """CAST(CAST(o_totalprice AS decimal(12,2)) * CAST(0.95 AS decimal(3,2))
                AS decimal(10,2)) AS discounted_total""",
        "CAST(o_orderkey % 5 + 1 AS int) AS total_products",
        f"CAST({_QUANTITIES} AS int) AS total_quantity",
        "o_orderdate AS created_at",
        "o_orderdate + make_dt_interval(0, CAST(o_orderkey % 25 AS int)) AS updated_at",
        "CASE WHEN o_orderstatus = 'F' THEN 'CANCELLED' ELSE 'COMPLETED' END AS status",
    )


ORDERS_SOURCE = """orders_source AS (
    SELECT o_orderkey AS id, o_custkey AS user_id,
        CAST(to_json(list_transform(range(1, o_orderkey % 5 + 2), lambda j: {
            'id': (o_custkey + 7 * j) % 100 + 1,
            'title': 'Product ' || ((o_custkey + 7 * j) % 100 + 1),
            'price': ((o_orderkey * 31 + j * 17) % 49000 + 1000) / 100,
            'quantity': (o_orderkey + j) % 3 + 1,
            'total': ((o_orderkey * 31 + j * 17) % 49000 + 1000)
                     * ((o_orderkey + j) % 3 + 1) / 100,
            'discountPercentage': CAST((o_orderkey + 3 * j) % 31 AS DOUBLE),
            'discountedPrice': ((o_orderkey * 31 + j * 17) % 49000 + 1000)
                     * (100 - (o_orderkey + 3 * j) % 31) / 10000
        })) AS VARCHAR) AS products_json,
        CAST(CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 7 = 0
             THEN -o_totalprice ELSE o_totalprice END AS DECIMAL(10,2)) AS total,
        CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.95 AS DECIMAL(3,2))
             AS DECIMAL(10,2)) AS discounted_total,
        CAST(o_orderkey % 5 + 1 AS INT) AS total_products,
        CAST(list_sum(list_transform(range(1, o_orderkey % 5 + 2),
             lambda j: (o_orderkey + j) % 3 + 1)) AS INT) AS total_quantity,
        o_orderdate AS created_at,
        o_orderdate + to_hours(CAST(o_orderkey % 25 AS BIGINT)) AS updated_at,
        CASE WHEN o_orderstatus = 'F' THEN 'CANCELLED' ELSE 'COMPLETED' END AS status
    FROM orders)"""

# --- users -----------------------------------------------------------------

_USER_COLUMNS = """
    c_custkey AS id,
    CASE WHEN c_custkey % 11 = 0 THEN NULL
         ELSE concat('  ', upper(c_name), '@Example.COM', chr(9)) END AS email,
    concat(chr(9), c_name, ' ') AS username,
    CASE WHEN c_custkey % 5 = 0 THEN concat(c_mktsegment, chr(10), 'x')
         WHEN c_custkey % 17 = 0 THEN NULL ELSE c_mktsegment END AS password,
    CASE WHEN c_custkey % 19 = 0 THEN NULL
         ELSE concat(' ', {first}, chr(9)) END AS firstName,
    CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE concat({last}, ' ') END AS lastName,
    CASE WHEN c_custkey % 3 = 0 THEN concat('+81 965-431-', 1000 + c_custkey % 9000)
         ELSE CAST(9000000000 + c_custkey AS {text}) END AS phone,
"""


def users_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as their API sends them.  The state comes from ``nation``, whose
    25 rows Spark broadcasts by their known size."""
    users = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    flat = _USER_COLUMNS.format(
        first="substring_index(c_name, '#', 1)", last="substring_index(c_name, '#', -1)",
        text="string",
    )
    return users.selectExpr(
        *_split(flat),
        """named_struct(
            'address', concat(c_custkey % 100, ' Main Street'),
            'city', concat('City ', c_custkey % 50),
            'state', n_name,
            'postalCode', CAST(10000 + c_custkey % 90000 AS string),
            'coordinates', named_struct('lat', (c_custkey % 180 - 90) / 2,
                                        'lng', (c_custkey % 360 - 180) / 4)) AS address""",
    )


def _split(columns: str) -> list[str]:
    """Column expressions of a comma-and-newline separated list."""
    return [c.strip() for c in columns.strip().rstrip(",").split(",\n") if c.strip()]


USERS_SOURCE = "users_source AS (SELECT" + _USER_COLUMNS.format(
    first="split_part(c_name, '#', 1)", last="split_part(c_name, '#', 2)", text="VARCHAR"
) + """
    (c_custkey % 100) || ' Main Street' AS address_line1,
    'City ' || (c_custkey % 50) AS address_city,
    n_name AS address_state,
    CAST(10000 + c_custkey % 90000 AS VARCHAR) AS address_postal_code,
    (c_custkey % 180 - 90) / 2 AS address_lat,
    (c_custkey % 360 - 180) / 4 AS address_lng
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

# --- products --------------------------------------------------------------

_PRODUCT_COLUMNS = """
    p_partkey AS id,
    CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE p_name END AS title,
    concat(p_name, ' by ', p_brand) AS description,
    CASE WHEN p_partkey % 10 = 3 THEN 'n/a'
         ELSE concat(p_partkey % 5, '.', p_partkey % 10) END AS rating,
    CASE p_partkey % 7 WHEN 0 THEN ' [1, {{"a": [2, 3]}}, 4]' WHEN 1 THEN '{{"stars": 4}}'
         WHEN 2 THEN CAST(p_size AS {text}) WHEN 3 THEN '3.9' WHEN 4 THEN 'none'
         WHEN 5 THEN '[]' END AS reviews,
    CASE WHEN p_partkey % 7 = 0 THEN -p_retailprice WHEN p_partkey % 31 = 0 THEN 0
         WHEN p_partkey % 37 = 0 THEN NULL ELSE p_retailprice END AS price,
    p_retailprice * 0.625 AS cost,
    CASE WHEN p_partkey % 12 = 5 THEN '5d' ELSE concat(p_partkey % 40, '.5') END
        AS discountPercentage,
    CASE WHEN p_partkey % 11 = 0 THEN 'bad' ELSE concat(' ', p_partkey % 900, '.25 ') END
        AS discountedPrice,
    p_size AS stock,
    concat(' ', lower(p_type), chr(9)) AS category,
    CASE WHEN p_partkey % 41 = 0 THEN NULL ELSE concat(lower(p_brand), chr(160)) END AS brand,
    concat('https://img.example/', p_partkey) AS thumbnail,
    concat('SKU-', p_partkey) AS sku,
    p_size * {half} AS weight,
    CASE WHEN p_partkey % 9 = 0 THEN 'no warranty'
         ELSE concat(p_size, ' month warranty') END AS warrantyInformation,
    concat(' ', p_size, ' days return policy ') AS returnPolicy,
    {updated} AS updated_at
"""


def products_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = _PRODUCT_COLUMNS.format(
        text="string", half="0.5D",
        updated="timestamp_ntz'2024-01-01 00:00:00'"
                " + make_dt_interval(0, CAST(p_partkey % 8760 AS int))",
    ).replace("0.625", "0.625D")
    return table(spark, sf_dir, "part").selectExpr(
        *_split(flat),
        """named_struct('width', p_size * 1.0D, 'height', p_partkey % 7 * 1.5D,
                        'depth', 2.5D) AS dimensions""",
    )


PRODUCTS_SOURCE = "products_source AS (SELECT" + _PRODUCT_COLUMNS.format(
    text="VARCHAR", half="CAST(0.5 AS DOUBLE)",
    updated="TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(p_partkey % 8760 AS BIGINT))",
).replace("0.625", "CAST(0.625 AS DOUBLE)").rstrip() + """,
    CAST(to_json({'width': p_size * CAST(1.0 AS DOUBLE),
                  'height': p_partkey % 7 * CAST(1.5 AS DOUBLE),
                  'depth': CAST(2.5 AS DOUBLE)}) AS VARCHAR) AS dimensions
    FROM part)"""

# --- logs ------------------------------------------------------------------


def mark_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watermark log: every event is one recorded run of a pipeline."""
    return table(spark, sf_dir, "events").selectExpr(
        "concat('incremental_', event_type) AS pipeline_name",
        "ts AS watermark_value",
        "CASE WHEN event_id % 9 = 0 OR event_type = 'error' THEN 'FAILED' "
        "ELSE 'SUCCESS' END AS status",
        "user_id AS rows_loaded",
        "ts AS recorded_at",
    )


MARK_LOG = """mark_log AS (
    SELECT 'incremental_' || event_type AS pipeline_name, ts AS watermark_value,
        CASE WHEN event_id % 9 = 0 OR event_type = 'error' THEN 'FAILED'
             ELSE 'SUCCESS' END AS status,
        user_id AS rows_loaded, ts AS recorded_at
    FROM events)"""


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run log: every event is one task; the runs are the hours of a type."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_type AS dag_id",
        "concat('task_', user_id) AS task_id",
        "concat(event_type, '_', date_format(ts, 'yyyyMMddHH')) AS run_id",
        "'hourly_incremental' AS run_type",
        "CASE WHEN event_id % 9 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status",
        "user_id AS rows_loaded",
        "CAST(value AS double) AS duration_seconds",
        "CASE WHEN event_id % 2 = 0 THEN concat(props, event_id) END AS error_message",
        "ts AS recorded_at",
    )


RUN_LOG = """run_log AS (
    SELECT event_type AS dag_id, 'task_' || user_id AS task_id,
        event_type || '_' || strftime(ts, '%Y%m%d%H') AS run_id,
        'hourly_incremental' AS run_type,
        CASE WHEN event_id % 9 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
        user_id AS rows_loaded, value AS duration_seconds,
        CASE WHEN event_id % 2 = 0 THEN props || event_id END AS error_message,
        ts AS recorded_at
    FROM events)"""

# --- API pages -------------------------------------------------------------


def as_pages(records: DataFrame, key: str, envelope: str, page_size: int = PAGE_SIZE) -> DataFrame:
    """Responses of up to ``page_size`` records, by key range.

    One row per key is left before the rows of a page are gathered, so a page
    never has more than ``page_size`` of them.  Times are written as text,
    since JSON output would cut them to milliseconds.
    """
    times = [f.name for f in records.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    records = records.withColumns({c: F.col(c).cast("string") for c in times})
    unique = keep_last(records, [key], [])
    page = F.floor(F.col(key) / page_size) + 1
    row = F.struct(key, *[c for c in unique.columns if c != key])
    body = F.to_json(F.struct(F.sort_array(F.collect_list(row)).alias(envelope)))
    return unique.groupBy(page.alias("page")).agg(body.alias("body"))


def page_rows(key: str, source: str, rest: list[str], page_size: int = PAGE_SIZE) -> str:
    """SQL: rows on pages up to the first that is not full.  Of the rows with
    one key the greatest by the other columns counts."""
    ties = ", ".join(f"{c} DESC NULLS LAST" for c in rest)
    return f"""single AS (SELECT * FROM {source}
        QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {ties}) = 1),
    numbered AS (SELECT *, {key} // {page_size} + 1 AS _page FROM single),
    paged AS (SELECT *, row_number() OVER (PARTITION BY _page ORDER BY {key}) - 1 AS _pos
        FROM numbered),
    page_sizes AS (SELECT _page, count(*) AS n FROM paged GROUP BY _page),
    wanted AS (SELECT * FROM paged WHERE _page <= coalesce(
        (SELECT min(_page) FROM page_sizes WHERE n < {page_size}), _page))"""


USER_TIES = ["email", "username", "password", '"firstName"', '"lastName"', "phone",
             "address_line1", "address_city", "address_state", "address_postal_code",
             "address_lat", "address_lng"]
EVENT_TIES = ["ts", "user_id", "event_type", "value", "props"]
PRODUCT_TIES = ["title", "description", "rating", "reviews", "price", "cost",
                '"discountPercentage"', '"discountedPrice"', "stock", "category", "brand",
                "thumbnail", "sku", "weight", '"warrantyInformation"', '"returnPolicy"',
                "updated_at"]
