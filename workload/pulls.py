"""API pages: landed, opened, typed."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.contracts import USER_RECORD
from medallion.functions.times import to_utc
from medallion.sources import pages
from medallion.sources.paged import pages_of
from medallion.sources.relational import id_cuts, id_predicates
from workload.adapters import (
    EVENT_TIES, PRODUCT_TIES, PRODUCTS_SOURCE, USER_TIES, USERS_SOURCE, as_pages, page_rows,
    products_source, table, users_source,
)
from workload.registry import RUN_1, new_folder, query

SINCE = datetime(2024, 1, 15, 12, 0, 0, 700_000)


def land(spark: SparkSession, responses: DataFrame) -> DataFrame:
    """Write responses to the shared folder, with their record counts, and read them as landed."""
    return pages.land_counted(responses, new_folder(spark))


def user_pages(spark: SparkSession, sf: str) -> DataFrame:
    return as_pages(users_source(spark, sf), "id", "users")


def event_pages(spark: SparkSession, sf: str) -> DataFrame:
    return as_pages(table(spark, sf, "events"), "event_id", "data")


@query(f"""WITH {USERS_SOURCE}, {page_rows('id', 'users_source', USER_TIES)}
    SELECT id, email, username, "firstName" AS first, address_city AS city, address_lat AS lat,
        _page, CAST(_pos AS INT) AS _pos FROM wanted""")
def scan_paged_json(spark: SparkSession, sf: str) -> DataFrame:
    landed = land(spark, user_pages(spark, sf))
    wanted = pages.keep_wanted_pages(pages.unwrap(landed), counts=landed)
    rows = pages.typed(pages.explode_records(wanted), USER_RECORD)
    return rows.select("id", "email", "username", F.col("firstName").alias("first"),
                       F.col("address.city").alias("city"),
                       F.col("address.coordinates.lat").alias("lat"), "_page", "_pos")


def fetch_landed(folder: str):
    """A fetch for ``pages_of`` that finds its responses in the shared folder, a folder for each page."""
    def fetch(offset: int, size: int, since: datetime | None) -> str | None:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        held = store.get_file_info(fs.FileSelector(f"{root}/page={offset // size + 1}", allow_not_found=True))
        for file in held:
            if file.size and not file.base_name.startswith(("_", ".")):
                with store.open_input_stream(file.path) as stream:
                    return stream.read().decode()
        return None

    return fetch


@query(f"""WITH {USERS_SOURCE}, {page_rows('id', 'users_source', USER_TIES)}
    SELECT id, email, username, _page, CAST(_pos AS INT) AS _pos FROM wanted""")
def scan_paged_source(spark: SparkSession, sf: str) -> DataFrame:
    """The same records as a scan of landed pages, fetched run by run; more pages are asked for than there are."""
    folder, landed = new_folder(spark), new_folder(spark)
    responses = user_pages(spark, sf)
    responses.write.partitionBy("page").text(folder)
    last = spark.read.text(folder).agg(F.max("page")).first()[0]
    pages_of(spark, fetch_landed(folder), pages=last + 5, run=4).select("page", "body", "n").write.parquet(landed)
    landed = spark.read.schema("page bigint, body string, n int").parquet(landed)
    rows = pages.typed(pages.explode_records(pages.keep_wanted_pages(pages.unwrap(landed), counts=landed)), USER_RECORD)
    return rows.select("id", "email", "username", "_page", "_pos")


# Eight shapes of a response, one per order: how many records each one holds.
_BODY = """CASE o_orderkey % 8
    WHEN 0 THEN concat('[{"id": ', o_orderkey, '}, {"id": ', o_custkey, '}]')
    WHEN 1 THEN concat('{"products": [{"id": ', o_orderkey, '}], "total": 1}')
    WHEN 2 THEN concat('{"products": {"id": ', o_orderkey, '}}')
    WHEN 3 THEN concat('{"data": [], "users": [{"id": ', o_orderkey, '}]}')
    WHEN 4 THEN concat('{"posts": [1, 2, 3], "results": [{"id": ', o_orderkey, '}]}')
    WHEN 5 THEN concat('', o_orderkey)
    WHEN 6 THEN concat('{"data": {"id": 1}, "carts": [{"id": ', o_orderkey, '},')
    ELSE NULL END"""


@query("""SELECT o_orderkey AS page, CASE o_orderkey % 8 WHEN 0 THEN 2 WHEN 1 THEN 1
    WHEN 4 THEN 1 ELSE 0 END AS n,
    CASE WHEN o_orderkey % 8 IN (0, 1, 4) THEN o_orderkey END AS first_id FROM orders""")
def unwrap_envelope(spark: SparkSession, sf: str) -> DataFrame:
    bodies = table(spark, sf, "orders").selectExpr("o_orderkey AS page", f"{_BODY} AS body")
    first = F.try_variant_get(F.try_element_at("records", F.lit(1)), "$.id", "bigint")
    return pages.unwrap(bodies).select("page", "n", first.alias("first_id"))


@query(f"""WITH {page_rows('event_id', 'events', EVENT_TIES, 64)}
    SELECT _page AS page, count(*) AS n FROM wanted GROUP BY 1""")
def page_stop(spark: SparkSession, sf: str) -> DataFrame:
    responses = as_pages(table(spark, sf, "events"), "event_id", "data", page_size=64)
    landed = land(spark, responses)
    return pages.keep_wanted_pages(landed, page_size=64).select("page", F.col("n").cast("bigint").alias("n"))


@query("""SELECT DISTINCT event_id // 100 + 1 AS page, event_id // 100 * 100 AS skip
    FROM events""")
def page_offset(spark: SparkSession, sf: str) -> DataFrame:
    return land(spark, event_pages(spark, sf)).select("page", pages.page_offset(F.col("page")).alias("skip"))


@query("""SELECT event_id, TIMESTAMP '2024-06-01' AS _extracted_at,
    'https://api.example/events' AS _source FROM events""")
def stamp_provenance(spark: SparkSession, sf: str) -> DataFrame:
    return pages.stamp(table(spark, sf, "events").select("event_id"), RUN_1,
                       "https://api.example/events")


@query("""SELECT event_id, ts, user_id FROM events WHERE ts > TIMESTAMP '2024-01-15 12:00:00'""")
def extract_since_events(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "ts", "user_id")
    return pages.changed_since(events, SINCE, "ts")


@query(f"""WITH {USERS_SOURCE}, {page_rows('id', 'users_source', USER_TIES)}
    SELECT id, email, username, password, "firstName", "lastName", phone,
        address_state AS state, _page, CAST(_pos AS INT) AS _pos,
        TIMESTAMP '2024-06-01' AS _extracted_at, '/users' AS _source FROM wanted""")
def read_users(spark: SparkSession, sf: str) -> DataFrame:
    rows = pages.read_users(land(spark, user_pages(spark, sf)), RUN_1)
    return rows.withColumn("state", F.col("address.state")).drop("address", "name", "updated_at")


@query(f"""WITH {PRODUCTS_SOURCE}, {page_rows('id', 'products_source', PRODUCT_TIES)}
    SELECT id, title, description, rating, reviews, CAST(price AS DOUBLE) AS price,
        "discountPercentage", "discountedPrice", stock, category, weight, "warrantyInformation",
        updated_at, _page, CAST(_pos AS INT) AS _pos,
        TIMESTAMP '2024-06-01' AS _extracted_at, '/products' AS _source
    FROM wanted WHERE updated_at > TIMESTAMP '2024-01-15 12:00:00'""")
def read_products(spark: SparkSession, sf: str) -> DataFrame:
    landed = land(spark, as_pages(products_source(spark, sf), "id", "products"))
    rows = pages.read_products(landed, RUN_1, since=SINCE)
    return rows.select(
        "id", "title", "description", "rating", "reviews",
        F.col("price").cast("double").alias("price"), "discountPercentage", "discountedPrice",
        "stock", "category", "weight", "warrantyInformation",
        to_utc(F.col("updated_at"), rows.schema["updated_at"].dataType).alias("updated_at"),
        "_page", "_pos", "_extracted_at", "_source")


@query(f"""WITH {page_rows('event_id', 'events', EVENT_TIES)}
    SELECT event_id, ts, user_id, event_type, value, props, _page, CAST(_pos AS INT) AS _pos,
        TIMESTAMP '2024-06-01' AS _extracted_at, '/events' AS _source FROM wanted""")
def read_events(spark: SparkSession, sf: str) -> DataFrame:
    rows = pages.read_events(land(spark, event_pages(spark, sf)), RUN_1)
    return rows.withColumn("ts", to_utc(F.col("ts"), rows.schema["ts"].dataType))


@query(f"""WITH {page_rows('event_id', 'events', EVENT_TIES)}
    SELECT event_id, _page, CAST(_pos AS INT) AS _pos FROM wanted""")
def arrival_order(spark: SparkSession, sf: str) -> DataFrame:
    landed = land(spark, event_pages(spark, sf))
    opened = pages.keep_wanted_pages(pages.unwrap(landed), counts=landed)
    rows = pages.typed(pages.explode_records(opened), "struct<event_id:bigint>")
    return rows.orderBy("_page", "_pos")


@query("""SELECT c_custkey AS id, c_name AS title, NULL AS brand, 'users' AS pull FROM customer
    UNION ALL SELECT p_partkey, p_name, p_brand, 'products' FROM part""")
def union_pages(spark: SparkSession, sf: str) -> DataFrame:
    users = table(spark, sf, "customer").selectExpr(
        "c_custkey AS id", "c_name AS title", "'users' AS pull")
    products = table(spark, sf, "part").selectExpr(
        "p_partkey AS id", "p_name AS title", "p_brand AS brand", "'products' AS pull")
    return pages.union_pulls(users, products).select("id", "title", "brand", "pull")


@query("""SELECT 16 AS parts, count(*) AS n, count(*) AS in_one_part, true AS balanced FROM orders""")
def split_by_id_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """The parts of a JDBC read of orders whose ids are squares, so that even ranges would hold unlike numbers of rows."""
    ids = table(spark, sf, "orders").select((F.col("o_orderkey") * F.col("o_orderkey")).alias("id"))
    conditions = id_predicates(id_cuts(ids, 16))
    held = [F.coalesce(F.expr(c), F.lit(False)) for c in conditions]
    found = ids.agg(F.count("*").alias("n"), F.count_if(sum(h.cast("int") for h in held) == 1).alias("in_one_part"),
                    F.greatest(*[F.count_if(h) for h in held]).alias("largest"))
    return found.select(F.lit(len(conditions)).alias("parts"), "n", "in_one_part",
                        (F.col("largest") <= 1.1 * F.col("n") / len(conditions) + 1).alias("balanced"))
