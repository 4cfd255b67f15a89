"""Landed pages of a JSON API.

A page is one response: ``page`` (1, 2, ...) and ``body`` (its JSON text).
Pages lie either one per file, or many per file in a table with these two
columns; the second form is the one for large pulls, since it does not need
a file for every hundred records.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion import contracts
from medallion.functions.times import instant, to_utc

# Fixed value: envelope keys, in the order they are looked up.
ENVELOPE_KEYS = ["data", "results", "items", "records", "users", "products", "carts", "posts"]
PAGE_SIZE = 100


# The last digits of a name are its page number: users_2024-06-01_page_0012.json is page 12.
PAGE_NUMBER = r"(\d+)\D*$"


class DuplicatePageError(ValueError):
    """Two files claim the same page."""


def read_page_files(spark: SparkSession, path: str, number: str = PAGE_NUMBER) -> DataFrame:
    """One response per file, numbered by a pattern on the file name; two files of one number are refused.

    Only the names are looked at for that, not the bodies.
    """
    files = spark.read.text(path, wholetext=True)
    page = F.regexp_extract(F.regexp_replace(F.col("_metadata.file_name"), r"\.\w+$", ""), number, 1)
    names = spark.read.format("binaryFile").load(path).select(F.regexp_extract(
        F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.\w+$", ""), number, 1).alias("page"))
    twice = names.groupBy("page").count().where("count > 1").limit(1).collect()
    if twice:
        raise DuplicatePageError(f"{twice[0]['count']} files in {path} have the page number {twice[0]['page'] or '(none)'}")
    return files.select(page.try_cast("bigint").alias("page"), F.col("value").alias("body"))


def read_page_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("page bigint, body string").parquet(path)


def unwrap(pages: DataFrame, keep_body: bool = False) -> DataFrame:
    """Add ``records`` and their count ``n`` to each page.

    The records are a bare list, else the first listed key that holds a list
    (an empty one counts), else none.  The parsed body is a column of its
    own: it is looked at once per key, but parsed once.
    """
    body = F.col("_body")
    found = [F.try_variant_get(body, path, "array<variant>")
             for path in ["$", *[f"$.{key}" for key in ENVELOPE_KEYS]]]
    parsed = pages.withColumn("_body", F.try_parse_json("body"))
    opened = parsed.withColumn("records", F.coalesce(*found)).drop(*([] if keep_body else ["body"]), "_body")
    return opened.withColumn("n", F.coalesce(F.size("records"), F.lit(0)))


def page_offset(page: Column, page_size: int = PAGE_SIZE) -> Column:
    return (page - 1) * page_size


def short_pages(pages: DataFrame, page_size: int = PAGE_SIZE) -> Column:
    """The first short page as a scalar subquery: no join is needed, and the comparison reaches the scan.

    Pages that carry their record count in a column ``n`` since they landed are
    not parsed for it: only the two narrow columns are scanned.
    """
    counted = pages if "n" in pages.columns else unwrap(pages)
    return counted.agg(F.min(F.when(F.col("n") < page_size, F.col("page")))).scalar()


def keep_wanted_pages(
    opened: DataFrame, page_size: int = PAGE_SIZE, max_pages: int | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Pages up to and including the first short one.

    ``counts`` are pages with ``n`` to find it in, the opened ones by default.
    Both sides are kept free of filters on ``n``: such a filter would be
    pushed below the parsed column and parse again.
    """
    wanted = F.col("page") <= F.coalesce(short_pages(opened if counts is None else counts, page_size), F.col("page"))
    if max_pages:
        wanted &= F.col("page") <= max_pages
    return opened.where(wanted)


def land_counted(pages: DataFrame, path: str) -> DataFrame:
    """Write pages with their record count beside the body, so that no later step parses a body to find the last page."""
    unwrap(pages, keep_body=True).select("page", "body", "n").write.parquet(path)
    return pages.sparkSession.read.schema("page bigint, body string, n int").parquet(path)


def left_out(pages: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """How many landed pages and records lie behind the first short page: ``pages, records``."""
    counted = pages if "n" in pages.columns else unwrap(pages)
    behind = F.col("page") > short_pages(counted, page_size)
    return counted.agg(F.count(F.when(behind, 1)).alias("pages"),
                       F.coalesce(F.sum(F.when(behind, F.col("n"))), F.lit(0)).cast("bigint").alias("records"))


def explode_records(opened: DataFrame) -> DataFrame:
    """One row per record, with its place of arrival ``_page``, ``_pos``;
    empty pages have none.

    The outer form, because for the inner one Spark infers a filter on the
    size of the list, pushes it below the parsed column and parses again.
    """
    rows = opened.select(
        F.col("page").alias("_page"), F.posexplode_outer("records").alias("_pos", "_record")
    )
    return rows.where(F.col("_pos").isNotNull())


def typed(records: DataFrame, record_type: str) -> DataFrame:
    """Give records their declared fields; a field of the wrong type is null."""
    row = F.try_variant_get("_record", "$", record_type).alias("r")
    return records.select(row, "_page", "_pos").select("r.*", "_page", "_pos")


def stamp(df: DataFrame, run_ts: datetime, source: str) -> DataFrame:
    return df.withColumns({"_extracted_at": instant(run_ts), "_source": F.lit(source)})


def changed_since(df: DataFrame, since: datetime | None, column: str) -> DataFrame:
    """Records changed after a bound, which is cut to whole seconds.

    A record without a change time cannot be shown to be old, so it is kept;
    the upsert makes a repeated pull harmless.
    """
    if since is None or column not in df.columns:
        return df
    changed = to_utc(F.col(column), df.schema[column].dataType)
    return df.where((changed > F.date_trunc("second", instant(since))) | changed.isNull())


def extract(
    pages: DataFrame,
    record_type: str,
    run_ts: datetime,
    source: str,
    page_size: int = PAGE_SIZE,
    max_pages: int | None = None,
    since: datetime | None = None,
    since_column: str = "updated_at",
    stop_at_short_page: bool = True,
) -> DataFrame:
    """Typed records of the landed pages, in their place of arrival.

    ``stop_at_short_page`` ends the pull behind the first page that is not
    full, as a reader of the live API would; ``left_out`` reports what that
    leaves out.  Without it every landed page is read.
    """
    opened = unwrap(pages)
    if stop_at_short_page:
        opened = keep_wanted_pages(opened, page_size, max_pages, counts=pages if "n" in pages.columns else None)
    elif max_pages:
        opened = opened.where(F.col("page") <= max_pages)
    rows = typed(explode_records(opened), record_type)
    return stamp(changed_since(rows, since, since_column), run_ts, source)


def read_products(pages: DataFrame, run_ts: datetime, since: datetime | None = None,
                  source: str = "/products", **scan) -> DataFrame:
    """A product that is sent without a status is an active one."""
    rows = extract(pages, contracts.PRODUCT_RECORD, run_ts, source, since=since, **scan)
    return rows.withColumn("status", F.coalesce("status", F.lit(contracts.DEFAULT_PRODUCT_STATUS)))


def read_users(pages: DataFrame, run_ts: datetime, since: datetime | None = None,
               source: str = "/users", **scan) -> DataFrame:
    return extract(pages, contracts.USER_RECORD, run_ts, source, since=since, **scan)


def read_events(pages: DataFrame, run_ts: datetime, since: datetime | None = None,
                source: str = "/events", **scan) -> DataFrame:
    return extract(pages, contracts.EVENT_RECORD, run_ts, source, since=since, since_column="ts", **scan)


def union_pulls(*pulls: DataFrame) -> DataFrame:
    """Bag union of pulls whose records may have different keys."""
    first, *rest = pulls
    for pull in rest:
        first = first.unionByName(pull, allowMissingColumns=True)
    return first
