"""SQL twins of the entity transforms and layers, as common table expressions."""

from medallion.contracts import ORDER_COLUMNS, PRODUCT_COLUMNS, USER_COLUMNS
from workload.adapters import ORDERS_SOURCE, PRODUCTS_SOURCE, USERS_SOURCE

STAMP = "TIMESTAMP '2024-06-01 00:00:00'"

# Fixed value: the white space that is cut at both ends.
_SPACE = """' ' || chr(9) || chr(10) || chr(13) || chr(160)"""


def strip(text: str) -> str:
    return f"trim({text}, {_SPACE})"


def key(prefix: str, column: str) -> str:
    return f"substr(sha256('{prefix}|' || {column}), 1, 16)"


def number(text: str) -> str:
    return f"""CASE WHEN regexp_full_match(trim({text}), '[-+]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][-+]?[0-9]+)?')
        THEN CAST(trim({text}) AS DOUBLE) END"""


def half_even(value: str) -> str:
    return f"round_even(({value}) * 100, 0) / 100"


def money(column: str) -> str:
    return f"greatest(coalesce(CAST({column} AS DOUBLE), 0), 0)"


def columns(*names: str) -> str:
    return ", ".join(names)


def ranked(source: str, keys: list[str], order: list[str], rest: list[str]) -> str:
    """SQL: last row per key; unknown times win, ties by the other columns."""
    by = [f"({c} IS NULL) DESC, {c} DESC" for c in order]
    by += [f"{c} DESC NULLS LAST" for c in rest]
    return f"""SELECT {columns(*keys, *order, *rest)} FROM (SELECT *, row_number() OVER (
        PARTITION BY {columns(*keys)} ORDER BY {columns(*by)}) AS rn FROM {source}) WHERE rn = 1"""


def last_rows(source: str, key: str, listed: list[str], order: list[str]) -> str:
    """SQL: all columns of the last row per key."""
    rest = [c for c in listed if c != key and c not in order
            and c not in ("_transformed_at", "_pipeline_version") and not c.startswith("sk_")]
    by = [f"({c} IS NULL) DESC, {c} DESC" for c in order]
    by += [f"{c} DESC NULLS LAST" for c in rest]
    return f"""SELECT * FROM {source}
        QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {columns(*by)}) = 1"""


ORDERS = f"""{ORDERS_SOURCE},
orders_enriched AS (
    SELECT id AS order_id, user_id, products_json,
        {money('total')} AS total, {money('discounted_total')} AS discounted_total,
        total_products, total_quantity, created_at AS order_date, updated_at,
        {key('order', 'id')} AS sk_order,
        {STAMP} AS _transformed_at, '1.0' AS _pipeline_version
    FROM orders_source WHERE id IS NOT NULL AND user_id IS NOT NULL),
orders_clean AS ({last_rows('orders_enriched', 'order_id', ORDER_COLUMNS, ['updated_at'])})"""

USERS = f"""{USERS_SOURCE},
user_names AS (
    SELECT *, {strip('firstName')} AS first_name, {strip('lastName')} AS last_name
    FROM users_source WHERE id IS NOT NULL AND email IS NOT NULL),
users_enriched AS (
    SELECT id AS user_id, lower({strip('email')}) AS email, {strip('username')} AS username,
        regexp_replace(password, '[^\\n]', '*', 'g') AS password_masked,
        first_name, last_name,
        trim(coalesce(first_name, '') || ' ' || coalesce(last_name, '')) AS full_name,
        address_line1, address_city, address_state, address_postal_code,
        address_lat, address_lng,
        CASE WHEN phone LIKE '+%' THEN phone
             ELSE repeat('*', length(phone) - 4) || right(phone, 4) END AS phone_masked,
        {key('user', 'id')} AS sk_user,
        {STAMP} AS _transformed_at, '1.0' AS _pipeline_version
    FROM user_names),
users_clean AS ({last_rows('users_enriched', 'user_id', USER_COLUMNS, [])})"""

REVIEWS = f"""CASE WHEN trim(reviews) LIKE '[%' THEN json_array_length(trim(reviews))
    WHEN trim(reviews) LIKE '{{%' THEN 1
    ELSE coalesce(trunc({number('reviews')}), 0) END"""

CLIPPED = "CASE WHEN price < 0 THEN 0 ELSE price END"

_PRODUCT_TIES = [c for c in PRODUCT_COLUMNS if c not in ("_extracted_at", "_source")]

PRODUCTS = f"""{PRODUCTS_SOURCE},
products_enriched AS (
    SELECT id, id AS product_id, title AS product_name, description,
        {number('rating')} AS rating,
        CAST({REVIEWS} AS INT) AS reviews,
        CAST({CLIPPED} AS DOUBLE) AS price,
        {number('discountPercentage')} AS discount_percentage,
        {number('discountedPrice')} AS discounted_price,
        stock, upper({strip('category')}) AS category, thumbnail, sku, weight, dimensions,
        TRY_CAST(nullif(regexp_extract(warrantyInformation, '[0-9]+'), '') AS INT)
            AS warranty_months,
        {strip('returnPolicy')} AS return_policy,
        {key('product', 'id')} AS sk_product,
        {STAMP} AS _transformed_at, '1.0' AS _pipeline_version
    FROM products_source WHERE id IS NOT NULL AND title IS NOT NULL),
products_clean AS ({last_rows('products_enriched', 'product_id', _PRODUCT_TIES, [])})"""

DAILY = """SELECT CAST(order_date AS DATE) AS sale_date, count(order_id) AS order_count,
        CAST(sum(CAST(total AS DECIMAL(12,2))) AS DOUBLE) AS total_revenue_usd,
        CAST(sum(CAST(total AS DECIMAL(12,2))) AS DOUBLE) / count(total) AS avg_order_value_usd,
        count(DISTINCT user_id) AS unique_customers"""
