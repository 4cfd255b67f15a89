"""What each entity must look like: names, keys, required columns, types.

Everything in this module is a fixed value: table names, column lists and
types are the interface that users of the layers query by name.
"""

from __future__ import annotations

from dataclasses import dataclass

PIPELINE_VERSION = "1.0"
DEFAULT_PRODUCT_STATUS = "ACTIVE"
DEFAULT_ORDER_STATUS = "COMPLETED"
CANCELLED = "CANCELLED"

# --- fixed values: source shapes ------------------------------------------

ORDER_SOURCE_COLUMNS = [
    "id", "user_id", "products", "total", "discounted_total",
    "total_products", "total_quantity", "created_at", "updated_at",
]

ORDER_ITEM = (
    "struct<id:bigint,title:string,price:double,quantity:int,total:double,"
    "discountPercentage:double,discountedPrice:double>"
)

USER_RECORD = (
    "struct<id:bigint,email:string,username:string,password:string,"
    "firstName:string,lastName:string,name:struct<firstname:string,lastname:string>,phone:string,"
    "address:struct<address:string,city:string,state:string,postalCode:string,"
    "coordinates:struct<lat:double,lng:double>>,"
    "updated_at:string>"
)

PRODUCT_RECORD = (
    "struct<id:bigint,title:string,description:string,rating:string,reviews:string,"
    "price:string,cost:string,list_price:string,status:string,discountPercentage:string,discountedPrice:string,stock:int,"
    "category:string,brand:string,thumbnail:string,sku:string,weight:double,"
    "dimensions:variant,"
    "warrantyInformation:string,returnPolicy:string,created_at:string,updated_at:string>"
)

EVENT_RECORD = (
    "struct<event_id:bigint,ts:string,user_id:bigint,event_type:string,"
    "value:double,props:string>"
)

# --- fixed values: output columns of the entity transforms -----------------

ORDER_COLUMNS = [
    "order_id", "user_id", "products_json", "total", "discounted_total",
    "total_products", "total_quantity", "order_date", "updated_at",
    "sk_order", "_transformed_at", "_pipeline_version",
]

USER_COLUMNS = [
    "user_id", "email", "username", "password_masked", "first_name", "last_name",
    "full_name", "address_line1", "address_city", "address_state",
    "address_postal_code", "address_lat", "address_lng", "phone_masked",
    "sk_user", "_transformed_at", "_pipeline_version",
]

PRODUCT_COLUMNS = [
    "id", "product_id", "product_name", "description", "rating", "reviews", "price",
    "discount_percentage", "discounted_price", "stock", "category", "thumbnail", "sku",
    "weight", "dimensions", "warranty_months", "return_policy", "sk_product",
    "_transformed_at", "_pipeline_version", "_extracted_at", "_source",
]

# --- fixed values: projections of the staging and analytics layers ---------

STG_USER_COLUMNS = USER_COLUMNS
STG_ORDER_COLUMNS = ORDER_COLUMNS
STG_PRODUCT_COLUMNS = [
    "product_id", "product_name", "description", "rating", "reviews", "price",
    "discount_percentage", "discounted_price", "stock", "category", "sku", "weight",
    "dimensions", "warranty_months", "return_policy", "sk_product",
    "_transformed_at", "_pipeline_version",
]

DIM_CUSTOMER_COLUMNS = [
    "user_id", "email", "username", "first_name", "last_name", "full_name",
    "address_city", "address_state", "address_postal_code", "sk_user",
]

DIM_PRODUCT_COLUMNS = [
    "product_id", "product_name", "price", "category", "discount_percentage",
    "discounted_price", "stock", "warranty_months", "sk_product",
]

FACT_ORDER_COLUMNS = [
    "order_id", "user_id", "products_json", "total", "discounted_total",
    "total_products", "total_quantity", "order_date", "updated_at", "sk_order",
]

# --- fixed values: raw and control tables ----------------------------------

ORDERS_RAW = {
    "order_id": "bigint", "user_id": "bigint", "products_json": "string",
    "total": "decimal(10,2)", "discounted_total": "decimal(10,2)",
    "total_products": "int", "total_quantity": "int",
    "order_value": "decimal(10,2)", "discount_amount": "decimal(10,2)",
    "avg_product_value": "decimal(10,2)",
    "order_date": "timestamp", "updated_at": "timestamp", "sk_order": "string",
    "_transformed_at": "timestamp", "_pipeline_version": "string",
    "_extracted_at": "timestamp", "_source": "string", "_loaded_at": "timestamp",
}

USERS_RAW = {
    "id": "bigint", "user_id": "bigint", "email": "string", "username": "string",
    "password_masked": "string", "first_name": "string", "last_name": "string",
    "full_name": "string", "address_line1": "string", "address_city": "string",
    "address_state": "string", "address_postal_code": "string",
    "address_lat": "decimal(11,8)", "address_lng": "decimal(11,8)",
    "phone_masked": "string", "sk_user": "string",
    "_transformed_at": "timestamp", "_pipeline_version": "string",
    "_extracted_at": "timestamp", "_source": "string", "_loaded_at": "timestamp",
}

PRODUCTS_RAW = {
    "id": "bigint", "product_id": "bigint", "product_name": "string",
    "description": "string", "rating": "decimal(3,2)", "reviews": "int",
    "price": "decimal(10,2)", "discount_percentage": "decimal(5,2)",
    "discounted_price": "decimal(10,2)", "stock": "int", "category": "string",
    "thumbnail": "string", "sku": "string", "weight": "decimal(10,2)",
    "dimensions": "string", "warranty_months": "int", "return_policy": "string",
    "sk_product": "string", "_transformed_at": "timestamp",
    "_pipeline_version": "string", "_extracted_at": "timestamp",
    "_source": "string", "_loaded_at": "timestamp",
}

EVENTS_RAW = {
    "event_id": "bigint", "ts": "timestamp", "user_id": "bigint",
    "event_type": "string", "value": "double", "props": "string",
    "_loaded_at": "timestamp",
}

WATERMARKS = {
    "pipeline_name": "string", "watermark_value": "timestamp", "status": "string",
    "rows_loaded": "bigint", "recorded_at": "timestamp",
}

RUN_METRICS = {
    "dag_id": "string", "task_id": "string", "run_id": "string", "run_type": "string",
    "status": "string", "rows_loaded": "bigint", "duration_seconds": "double",
    "error_message": "string", "recorded_at": "timestamp",
}

# --- fixed values: tables of the staging and analytics layers --------------


def _types(columns: list[str], table: dict[str, str]) -> dict[str, str]:
    return {c: table[c] for c in columns}


STG_ORDERS = _types(STG_ORDER_COLUMNS, ORDERS_RAW)
STG_USERS = _types(STG_USER_COLUMNS, USERS_RAW)
STG_PRODUCTS = _types(STG_PRODUCT_COLUMNS, PRODUCTS_RAW)
DIM_CUSTOMERS = _types(DIM_CUSTOMER_COLUMNS, USERS_RAW)
DIM_PRODUCTS = _types(DIM_PRODUCT_COLUMNS, PRODUCTS_RAW)
FACT_ORDERS = _types(FACT_ORDER_COLUMNS, ORDERS_RAW)
AGG_DAILY_SALES = {
    "sale_date": "date", "order_count": "bigint", "total_revenue_usd": "double",
    "avg_order_value_usd": "double", "unique_customers": "bigint",
}


@dataclass(frozen=True)
class Entity:
    """One data set that travels through the layers.

    ``arrival`` orders the copies of a key from first to last; ``marks`` are
    the watermark candidates in order of preference.  Exactly one of
    ``date_key`` and hash buckets of ``keys`` decides the table partition.
    """

    name: str
    table: str
    columns: dict[str, str]
    keys: tuple[str, ...]
    required: tuple[str, ...]
    gate: tuple[str, ...]
    arrival: tuple[str, ...]
    marks: tuple[str, ...]
    watermark_name: str
    cluster: tuple[str, ...]
    date_key: str | None = None


ORDERS = Entity(
    name="orders", table="orders_raw", columns=ORDERS_RAW, keys=("order_id",),
    required=("order_id", "user_id"), gate=("order_id", "user_id", "order_date"),
    arrival=("updated_at",), marks=("updated_at", "created_at", "_extracted_at"),
    watermark_name="incremental_orders", cluster=("updated_at", "order_id"),
    date_key="order_date",
)
USERS = Entity(
    name="users", table="users_raw", columns=USERS_RAW, keys=("user_id",),
    required=("user_id", "email"), gate=("user_id", "email"),
    arrival=("_page", "_pos"), marks=("updated_at", "_extracted_at"),
    watermark_name="incremental_users", cluster=("user_id",),
)
PRODUCTS = Entity(
    name="products", table="products_raw", columns=PRODUCTS_RAW, keys=("product_id",),
    required=("product_id", "product_name"), gate=("product_id", "product_name"),
    arrival=("_page", "_pos"), marks=("updated_at", "_extracted_at"),
    watermark_name="incremental_products", cluster=("product_id", "category"),
)
EVENTS = Entity(
    name="events", table="api_events_raw", columns=EVENTS_RAW, keys=("event_id",),
    required=("event_id",), gate=("event_id",),
    arrival=("ts",), marks=("ts", "_extracted_at"),
    watermark_name="incremental_events", cluster=("ts", "event_id"), date_key="ts",
)
ENTITIES = {e.name: e for e in (ORDERS, USERS, PRODUCTS, EVENTS)}
