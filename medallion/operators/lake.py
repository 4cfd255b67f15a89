"""Tables of the layers and the ways to load them.

Tables are plain parquet tables of the session catalog, one database per
layer.  ``_part`` is the partition column of the large ones: the period of
the date key where the entity has one, else a hash bucket of the key.

Every load writes a version of its own and then switches to it; see
``medallion.operators.commit``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion import contracts
from medallion.contracts import Entity
from medallion.functions.keys import bucket
from medallion.functions.nested import json_text
from medallion.operators.commit import PART, Files, Place, changed_since, commit, last_version, writing
from medallion.operators.quality import gate_metrics
from medallion.session import prepare

LAYERS = ("raw", "staging", "analytics", "control")
NO_DATE = "none"
# Properties of a table without a date: the buckets that rows written from now on go to, and its rows.
BUCKETS, ROWS = "medallion.buckets", "medallion.rows"
# Property of a table built from another one: the version of that one.
BUILT_FROM = "medallion.built_from"
# Column of the raw tables: a hash of a row's values, by which an upsert sees that a row has not changed.
DIGEST = "_digest"
# Rows that the ranges of a Z-order are found in, and the bits of a column's rank.
Z_SAMPLE, Z_BITS = 8192, 6
# Bloom filters of keys: the smallest of several sizes that holds a row group's values.
BLOOM = {"parquet.bloom.filter.adaptive.enabled": "true", "parquet.bloom.filter.candidates.number": "12",
         "parquet.bloom.filter.max.bytes": str(8 << 20), "parquet.bloom.filter.fpp": "0.0001"}


@dataclass(frozen=True)
class Lake:
    """Where the tables are.

    ``period`` is the date pattern of the date partitions (``yyyy-MM`` or,
    for tables whose months are too large to rewrite, ``yyyy-MM-dd``).  Tables
    without a date have hash buckets of about ``bucket_rows`` rows.  The number
    of buckets, a power of two and a property of the table, doubles as the
    table grows.  A bucket's name tells of how many it is one, so that buckets
    of several generations stand side by side: one that was written when there
    were fewer is split when a load touches it, and not before.
    """

    spark: SparkSession
    root: str
    prefix: str = ""
    period: str = "yyyy-MM"
    bucket_rows: int = 250_000
    entities: dict[str, Entity] = field(default_factory=lambda: contracts.ENTITIES)

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}{layer}.{table}"

    def raw(self, entity: Entity) -> str:
        return self.name("raw", entity.table)

    def table(self, layer: str, table: str) -> DataFrame:
        """Rows of a table, without the columns that are there for the layout."""
        return self.spark.table(self.name(layer, table)).drop(PART, DIGEST)

    def place(self, layer: str, table: str) -> Place:
        name = self.name(layer, table)
        return Place(self.spark, name, f"{self.root}/_versions/{layer}/{table}", f"{self.root}/_work/{layer}/{table}",
                     PART in self.spark.table(name).columns)

    def raw_place(self, entity: Entity) -> Place:
        return self.place("raw", entity.table)

    def number(self, entity: Entity, key: str, default: int) -> int:
        """A property of the raw table."""
        found = self.spark.sql(f"SHOW TBLPROPERTIES {self.raw(entity)} ('{key}')").first()["value"]
        return int(found) if found.isdigit() else default

    def bucket_count(self, entity: Entity) -> int:
        """Buckets that rows are written to now."""
        return self.number(entity, BUCKETS, 1)

    def buckets_for(self, rows: int) -> int:
        """A power of two, so that a table that grows can double them."""
        return 1 << max(0, math.ceil(math.log2(max(1, rows / self.bucket_rows))))

    def grown(self, entity: Entity, more: int) -> dict[str, int]:
        """Properties of a table that ``more`` rows are added to; none for tables with a date."""
        if entity.date_key:
            return {}
        rows = self.number(entity, ROWS, 0) + more
        return {ROWS: rows, BUCKETS: max(self.bucket_count(entity), self.buckets_for(rows))}

    def part_of(self, entity: Entity, buckets: int | None = None) -> Column:
        if entity.date_key:
            return F.coalesce(F.date_format(entity.date_key, self.period), F.lit(NO_DATE))
        count = buckets or self.bucket_count(entity)
        return F.concat(F.lit(f"{count}."), bucket(list(entity.keys), count).cast("string"))

    def holders(self, df: DataFrame, entity: Entity) -> list[str]:
        """Partitions that hold the keys of a frame now; not of dates, which a change may move."""
        names = {r[0].split("=", 1)[1] for r in self.spark.sql(f"SHOW PARTITIONS {self.raw(entity)}").collect()}
        counts = sorted({int(n.split(".")[0]) for n in names})
        if not counts:
            return []
        found = df.select(F.explode(F.array(*[self.part_of(entity, n) for n in counts])).alias(PART))
        return [r[0] for r in found.distinct().collect() if r[0] in names]  # generations x buckets touched

    def setup(self) -> "Lake":
        """Create the databases and tables that are absent."""
        prepare(self.spark)
        for layer in LAYERS:
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {self.prefix}{layer} "
                f"LOCATION '{self.root}/{layer}'"
            )
        for entity in self.entities.values():
            self._create(self.raw(entity), entity.columns | {DIGEST: "bigint"}, partitioned=True)
            if DIGEST not in self.spark.table(self.raw(entity)).columns:  # rows written before have none
                self.spark.sql(f"ALTER TABLE {self.raw(entity)} ADD COLUMNS ({DIGEST} bigint)")
        for table, columns in (("stg_orders", contracts.STG_ORDERS),
                               ("stg_users", contracts.STG_USERS),
                               ("stg_products", contracts.STG_PRODUCTS)):
            self._create(self.name("staging", table), columns, partitioned=True)
        self._create(self.name("analytics", "fact_orders"), contracts.FACT_ORDERS,
                     partitioned=True)
        self._create(self.name("analytics", "dim_customers"), contracts.DIM_CUSTOMERS)
        self._create(self.name("analytics", "dim_products"), contracts.DIM_PRODUCTS)
        self._create(self.name("analytics", "agg_daily_sales"), contracts.AGG_DAILY_SALES)
        self._create(self.name("control", "etl_watermarks"), contracts.WATERMARKS)
        self._create(self.name("control", "pipeline_run_metrics"), contracts.RUN_METRICS)
        return self

    def drop(self) -> None:
        """Remove the databases, their tables and all files of the lake."""
        for layer in LAYERS:
            self.spark.sql(f"DROP DATABASE IF EXISTS {self.prefix}{layer} CASCADE")
        Files(self.spark).delete(self.root)

    def _create(self, name: str, columns: dict[str, str], partitioned: bool = False) -> None:
        fields = [f"`{c}` {t}" for c, t in columns.items()]
        layout = ""
        if partitioned:
            fields.append(f"`{PART}` string")
            layout = f" PARTITIONED BY ({PART})"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(fields)}) USING parquet{layout}"
        )


def write_step(df: DataFrame, path: str, metrics: list[Column] | None = None,
               partitioned: bool = False, keys: tuple[str, ...] = ()) -> tuple[DataFrame, dict]:
    """Write a step of a load to a new folder; returns it read back, and metrics of its rows.

    Row groups get a Bloom filter of each of the ``keys``, as small as its values allow, so that a look-up of few
    keys skips those without any of them, however the keys are spread.

    The metrics sit on top of the last stage of the write, whose tasks report
    once each, so a lost executor does not count rows twice.
    """
    seen = Observation()
    writer = df.observe(seen, *(metrics or gate_metrics([]))).write
    if partitioned:
        writer = writer.partitionBy(PART)
    for key in keys:
        writer = writer.options(**{f"parquet.bloom.filter.enabled#{key}": "true"}, **BLOOM)
    writer.parquet(path)
    return df.sparkSession.read.schema(nullable(df.schema)).parquet(path), seen.get


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def conform(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The table's columns that the frame has, in the table's types."""
    unknown = [c for c in df.columns if c not in columns]
    if unknown:
        raise ValueError(f"columns unknown to the target table: {unknown}")
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in columns.items() if c in df.columns])


def complete(df: DataFrame, columns: dict[str, str], defaults: dict[str, Column]) -> DataFrame:
    """All columns of the table: absent ones get their default, else null."""
    def value(name: str, dtype: str) -> Column:
        if name in df.columns:
            return F.col(name)
        return defaults.get(name, F.lit(None)).cast(dtype).alias(name)

    return df.select(*[value(c, t) for c, t in columns.items()])


def stamps(entity: Entity) -> list[str]:
    """Columns that say when a row was handled, and nothing about the row."""
    return [c for c, t in entity.columns.items() if c.startswith("_") and t == "timestamp"]


def digest(entity: Entity) -> Column:
    """64-bit hash of a row's values: all columns but keys and stamps.

    Of two different rows of a key, one in 2**64 hashes alike.  Nulls are hashed as such: the hash function itself
    passes over them, so that a value could move to the column beside it unseen.
    """
    left_out = {*entity.keys, *stamps(entity)}
    parts = [F.lit(len(entity.columns))]
    for name, dtype in entity.columns.items():
        if name not in left_out:
            nested = dtype.startswith(("array", "map", "struct", "variant"))
            parts += [F.col(name).isNull(), F.to_json(F.struct(name)) if nested else F.col(name)]
    return F.xxhash64(*parts)


def laid_out(df: DataFrame, entity: Entity) -> DataFrame:
    """Rows of a partition together, sorted inside the files.

    Rebalancing, unlike a plain repartition, lets AQE split a partition that
    holds a large part of all rows over many tasks and files.
    """
    return sorted_in_files(df.hint("rebalance", PART), entity)


def sorted_in_files(df: DataFrame, entity: Entity) -> DataFrame:
    return df.sortWithinPartitions(PART, *entity.cluster)


def replace(lake: Lake, df: DataFrame, entity: Entity, loaded_at: Column,
            check=None) -> int:
    """Full replace.  Without rows the table stays as it is.

    The rows are written once, into a version that the table switches to after
    they have been counted and checked.  Where buckets follow the number of
    rows, that is counted first, from a staged copy.
    """
    with writing(lake.raw_place(entity)) as version:
        rows = complete(conform(df, entity.columns), entity.columns, {"_loaded_at": loaded_at})
        properties, part = {}, lake.part_of(entity) if entity.date_key else None
        if part is None:
            rows, seen = write_step(rows, version.step("stage"))
            properties = {ROWS: seen["rows"], BUCKETS: lake.buckets_for(seen["rows"])}
            part = lake.part_of(entity, properties[BUCKETS])
        rows = laid_out(rows.withColumns({DIGEST: digest(entity), PART: part}), entity)
        seen = write_step(rows, version.data, gate_metrics(list(entity.gate)), partitioned=True, keys=entity.keys)[1]
        if check:
            check(seen)
        if seen["rows"]:
            commit(version, properties=properties)
        return seen["rows"]


def rebuild(lake: Lake, df: DataFrame, layer: str, table: str, cluster_by: list[str] | None = None,
            wait: float = 0.0, touched: list[str] | None = None, properties: dict[str, int] | None = None) -> None:
    """Replace all rows of a table by those of a query, or those of the ``touched`` partitions; the old ones stay until
    the new ones are complete.

    A query over a partitioned table passes the partition column on: its rows
    are then copied without a shuffle.  ``cluster_by`` sorts the rows into
    disjoint ranges of the column instead, or of several columns interleaved.
    """
    place = lake.place(layer, table)
    if cluster_by:
        df = interleaved(df, cluster_by) if len(cluster_by) > 1 else clustered(df, cluster_by)
    columns = lake.spark.table(place.name).schema
    df = df.select(*[F.col(f.name).cast(f.dataType) for f in columns.fields])
    with writing(place, wait) as version:
        write_step(df, version.data, partitioned=place.partitioned)
        commit(version, touched, properties)


def refresh(lake: Lake, source: Place, layer: str, table: str, rows, full: bool = False,
            cluster_by: list[str] | None = None) -> bool:
    """Bring a table that is built from another one up to date; False if nothing has changed.

    The table keeps the source's version that it was built from.  The source's history says which partitions have
    changed since; ``rows(touched)`` gives the new rows of those partitions, which a partitioned table has too, and
    ``rows(None)`` those of all.  A table without partitions is written anew, from what ``rows`` gives.
    """
    place = lake.place(layer, table)
    upto = last_version(source)  # before the rows are read: later versions are seen again by the next build
    found = lake.spark.sql(f"SHOW TBLPROPERTIES {place.name} ('{BUILT_FROM}')").first()["value"]
    touched = None if full or not found.isdigit() else changed_since(source, int(found))
    if touched is not None and not touched:
        return False
    touched = None if touched is None else sorted(touched)
    rebuild(lake, rows(touched), layer, table, cluster_by, touched=touched if place.partitioned else None,
            properties={BUILT_FROM: upto})
    return True


def parts_of(df: DataFrame, touched: list[str] | None) -> DataFrame:
    """The rows of some partitions."""
    return df if touched is None else df.where(F.col(PART).isin(touched))


def clustered(df: DataFrame, by: list[str]) -> DataFrame:
    """Disjoint key ranges per file, sorted.  End ``by`` with a unique column
    where the first one may repeat often: equal keys cannot be split."""
    return df.repartitionByRange(*by).sortWithinPartitions(*by)


def range_rank(column: str, bounds: list) -> Column:
    """How many of the sorted ``bounds`` a value is not below; 0 for nulls.  A tree of comparisons: their logarithm a row."""
    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col(column) < F.lit(bounds[middle]), between(low, middle)).otherwise(between(middle + 1, high))

    return F.when(F.col(column).isNull(), F.lit(0)).otherwise(between(0, len(bounds)))


def z_value(df: DataFrame, by: list[str], bits: int = Z_BITS) -> Column:
    """Interleaved bits of the range ranks of several columns, so that rows alike in any of them lie near each other.

    Each column is cut into ``2**bits`` ranges of about equal numbers of rows, found in the ``Z_SAMPLE`` rows of the
    smallest hashes: a bounded sample, for the layout alone, and the same in every run.
    """
    sample = df.select(*by).orderBy(F.xxhash64(*by)).limit(Z_SAMPLE).collect()
    z = F.lit(0).cast("bigint")
    for i, column in enumerate(by):
        values = sorted(r[column] for r in sample if r[column] is not None)
        ranges = 1 << bits
        bounds = sorted({values[len(values) * j // ranges] for j in range(1, ranges)}) if values else []
        rank = range_rank(column, bounds).cast("bigint")
        for bit in range(bits):
            z += F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)), bit * len(by) + len(by) - 1 - i)
    return z


def interleaved(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows in files by ranges of several columns at once (Z-order): a filter on any of them skips most row groups.

    Ranges are cut by the columns themselves too, so that many rows of one cell fill several files.
    """
    cell = z_value(df, by)
    return df.repartitionByRange(cell, *by).sortWithinPartitions(cell, *by)


def export_csv(df: DataFrame, folder: str, name: str, run_ts: datetime) -> str:
    """One folder of CSV files with headers; nested values as JSON text."""
    nested = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
    df = df.withColumns({f.name: json_text(F.col(f.name), f.dataType)
                         for f in df.schema.fields if isinstance(f.dataType, nested)})
    path = f"{folder}/{name}_{run_ts:%Y%m%d_%H%M%S}"
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path
