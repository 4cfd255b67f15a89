"""Orders from a relational source: a table, parquet files or JDBC."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.contracts import ORDER_SOURCE_COLUMNS
from medallion.functions.times import as_utc, instant, to_utc


def typed_times(df: DataFrame) -> DataFrame:
    """Instants where the source had text or zone-less timestamps."""
    times = [c for c in ("created_at", "updated_at") if c in df.columns]
    return df.withColumns({c: to_utc(F.col(c), df.schema[c].dataType) for c in times})


def changed_after(df: DataFrame, mark: datetime | None, column: str = "updated_at") -> DataFrame:
    """Rows strictly past the mark; rows without a time are not.  No mark: all.

    The comparison stays on the column as stored, so that the scan can skip
    row groups by it.
    """
    if mark is None:
        return df
    bound = instant(mark)
    if df.schema[column].dataType.typeName() == "timestamp_ntz":
        bound = bound.cast("timestamp_ntz")
    return df.where(F.col(column) > bound)


def by_update_time(df: DataFrame) -> DataFrame:
    """Oldest change first, unknown times last; the id keeps one busy instant
    from becoming one sort partition."""
    return df.orderBy(F.col("updated_at").asc_nulls_last(), F.col("id"))


def extract_orders(
    source: DataFrame, watermark: datetime | None = None, limit: int | None = None
) -> DataFrame:
    """The nine order columns, optionally changed after a watermark.

    The order of the rows matters only together with a limit, so only then
    is it paid for (as a top-k, not as a full sort).
    """
    rows = changed_after(source.select(*ORDER_SOURCE_COLUMNS), watermark)
    if limit:
        rows = by_update_time(rows).limit(limit)
    return typed_times(rows)


def jdbc_options(
    url: str,
    table: str = "orders",
    watermark: datetime | None = None,
    limit: int | None = None,
    id_bounds: tuple[int, int] | None = None,
    num_partitions: int = 32,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of the JDBC scan.

    The id bounds split the read over ``num_partitions`` tasks; without them
    the whole table would come through one connection, which is refused.  A
    limit must be taken by the database, so it goes into the query text, and
    its rows come through one.
    """
    columns = ", ".join(ORDER_SOURCE_COLUMNS)
    query = f"SELECT {columns} FROM {table}{_after(watermark)}"
    options = {"url": url, "fetchsize": str(fetch_size)}
    if limit:
        return options | {"query": f"{query} ORDER BY updated_at ASC LIMIT {int(limit)}"}
    if id_bounds is None:
        raise ValueError("a JDBC read without a limit needs id_bounds to be split by")
    low, high = id_bounds
    return options | {
        "dbtable": f"({query}) changed_orders", "partitionColumn": "id", "lowerBound": str(low),
        "upperBound": str(max(high, low + 1)), "numPartitions": str(num_partitions),
    }


def id_cuts(ids: DataFrame, parts: int, accuracy: int = 10_000) -> list[int]:
    """At most ``parts - 1`` ids that cut the column ``id`` into parts of about equal numbers of rows.

    A quantile sketch, merged from the tasks, gives them: even ranges of a sparse id space would leave most parts
    empty and one with most rows.  A part is off by ``rows / accuracy``, and by the rows of one id.
    """
    if parts < 2:
        return []
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    found = ids.agg(F.percentile_approx(F.col("id").cast("bigint"), shares, accuracy).alias("cuts")).first()["cuts"]
    return sorted(set(found or []))


def id_predicates(cuts: list[int]) -> list[str]:
    """Conditions of which every row meets one: ranges that end with each cut, the last one with null ids."""
    if not cuts:
        return ["1 = 1"]
    between = [f"id > {a} AND id <= {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"id <= {cuts[0]}", *between, f"id > {cuts[-1]} OR id IS NULL"]


def read_orders_split(spark: SparkSession, url: str, cuts: list[int], table: str = "orders",
                      watermark: datetime | None = None, properties: dict[str, str] | None = None) -> DataFrame:
    """Orders over JDBC, a task for each of the ranges of ``id_predicates``; the cuts may come from an earlier load."""
    columns = ", ".join(ORDER_SOURCE_COLUMNS)
    changed = f"(SELECT {columns} FROM {table}{_after(watermark)}) changed_orders"
    return typed_times(spark.read.jdbc(url, changed, predicates=id_predicates(cuts), properties=properties or {}))


def id_range_options(url: str, table: str = "orders", watermark: datetime | None = None) -> dict[str, str]:
    """Options of the small query that finds the range of ids to split the scan by."""
    return {"url": url, "query": f"SELECT MIN(id) AS low, MAX(id) AS high FROM {table}{_after(watermark)}"}


def _after(watermark: datetime | None) -> str:
    if watermark is None:
        return ""
    mark = as_utc(watermark).strftime("%Y-%m-%d %H:%M:%S.%f+00:00")
    return f" WHERE updated_at > TIMESTAMP WITH TIME ZONE '{mark}'"


def read_orders_jdbc(spark: SparkSession, url: str, properties: dict[str, str] | None = None,
                     **scan) -> DataFrame:
    """Orders over JDBC.  Bounds that are not given are asked of the database first."""
    def read(options: dict[str, str]) -> DataFrame:
        return spark.read.format("jdbc").options(**options).options(**(properties or {})).load()

    if not scan.get("limit") and scan.get("id_bounds") is None:
        which = {k: scan[k] for k in ("table", "watermark") if k in scan}
        low, high = read(id_range_options(url, **which)).first()
        scan["id_bounds"] = (low or 0, high or 0)
    return typed_times(read(jdbc_options(url, **scan)))


def profile(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.min("updated_at").alias("first_update"),
        F.max("updated_at").alias("last_update"),
    )
