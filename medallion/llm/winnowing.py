"""Document fingerprints by winnowing, in DataFrame functions only.

A text's units are its words, and single characters of scripts that write none.  Every run of ``GRAM`` units has a
Karp-Rabin hash, built by doubling from the hashes of shorter runs, so each is two steps however long the run.  Of
every ``WINDOW`` runs in a row the one with the smallest hash is chosen, the rightmost of equals, and kept with its
position.  Two texts that share ``GRAM + WINDOW - 1`` units in a row share a chosen run there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medallion.llm.common import stored, table
from medallion.llm.registry import query

GRAM, WINDOW = 4, 6
GUARANTEE = GRAM + WINDOW - 1
# Prime modulus of the rolling hash: products of two values fit a long.
PRIME, BASE = (1 << 31) - 1, 1_000_003
_ALONE = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}"
UNIT = rf"([{_ALONE}]|[^\x20\x09-\x0D{_ALONE}]+)"
# Neighbours by id meet in buckets of this many ids.
BUCKET, UPPER = 256, 4096


def _pairs(runs: Column, step: int) -> Column:
    """Hashes of runs twice as long as those given, which are of ``step`` units."""
    return F.transform(F.slice(runs, F.lit(1), F.greatest(F.size(runs) - step, F.lit(0))),
                       lambda v, i: (v * F.lit(pow(BASE, step, PRIME)) + F.get(runs, i + step)) % PRIME)


def with_marks(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: the chosen runs of a text column, each as hash * 2**31 + (2**31 - 1 - position), by position.

    A text of fewer than ``GRAM`` units is one run of all its units; one without units, or null, has none.
    """
    units = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(UNIT), F.lit(1))
    df = df.withColumn("_u", F.transform(units, lambda u: F.pmod(F.xxhash64(u), F.lit(PRIME))))
    size = 1
    df = df.withColumn("_r", F.col("_u"))
    while size < GRAM:
        df, size = df.withColumn("_r", _pairs(F.col("_r"), size)), 2 * size
    short = F.array((F.aggregate("_u", F.lit(0).cast("long"), lambda h, u: (h * BASE + u) % PRIME)))
    df = df.withColumn("_r", F.when(F.size("_u") >= GRAM, F.col("_r")).when(F.size("_u") > 0, short).otherwise(F.array().cast("array<long>")))
    df = df.withColumn("_r", F.transform("_r", lambda v, i: v * F.lit(1 << 31) + (F.lit(PRIME) - i)))
    windows = F.transform(F.sequence(F.lit(1), F.greatest(F.size("_r") - WINDOW + 1, F.lit(1))), lambda i: F.array_min(F.slice("_r", i, F.lit(WINDOW))))
    return df.withColumn(out, F.when(F.size("_r") > 0, F.array_distinct(windows)).otherwise(F.array().cast("array<long>"))).drop("_u", "_r")


def hashes(marks: Column) -> Column:
    """The different hashes of chosen runs."""
    return F.array_distinct(F.transform(marks, lambda m: F.shiftright(m, 31)))


def positions(marks: Column) -> Column:
    """The units at which chosen runs begin, from 0."""
    return F.transform(marks, lambda m: (F.lit(PRIME) - m % F.lit(1 << 31)).cast("int"))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two arrays of different hashes; 1 if both are empty."""
    shared = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - shared
    return F.when(either == 0, F.lit(1.0)).otherwise(shared / either)


def digest(marks: Column) -> Column:
    """128 bits of hex for a whole fingerprint, positions included."""
    return F.lower(F.concat(F.lpad(F.hex(F.xxhash64(marks)), 16, "0"), F.lpad(F.hex(F.xxhash64(F.lit(1), marks)), 16, "0")))


def _following(buckets: DataFrame) -> DataFrame:
    """``bucket, next``: the next bucket that has rows, after the last the first; in two levels."""
    buckets = buckets.withColumn("upper", F.floor(F.col("bucket") / UPPER))
    tops = buckets.groupBy("upper").agg(F.min("bucket").alias("least"))
    order = Window.orderBy("upper")  # a row for BUCKET * UPPER ids
    tops = tops.select("upper", F.coalesce(F.lead("least").over(order), F.min("least").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    return (buckets.withColumn("near", F.lead("bucket").over(Window.partitionBy("upper").orderBy("bucket"))).join(tops, "upper")
            .select("bucket", F.coalesce("near", "after").alias("next")))


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, marks, next_text, next_marks`` for every row; nulls count as empty, null ids come first.

    Rows follow each other by id, then text; after the last comes the first.  They meet in buckets of neighbouring
    ids, each with a copy of the next bucket's first row, so the texts are shuffled once.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("bucket", F.coalesce(F.floor(F.col("doc_id") / BUCKET), F.lit(-(1 << 54))))
    firsts = stored(docs.groupBy("bucket").agg(F.min(F.struct("doc_id", "text")).alias("row")))
    ahead = _following(firsts.select("bucket")).join(firsts.withColumnRenamed("bucket", "next"), "next")
    ahead = ahead.select(F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"), "bucket", F.lit(True).alias("copy"))
    rows = docs.withColumn("copy", F.lit(False)).unionByName(ahead).repartition("bucket")
    order = Window.partitionBy("bucket").orderBy("copy", "doc_id", "text")
    rows = with_marks(rows, "text", "marks")
    return (rows.withColumn("next_text", F.lead("text").over(order)).withColumn("next_marks", F.lead("marks").over(order))
            .where(~F.col("copy")).drop("bucket", "copy"))


@query()
def op5_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_next(table(spark, sf_dir, "documents"))
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut)))
    rows = with_marks(rows, "edited", "edited_marks")
    own = hashes(F.col("marks"))
    return rows.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), digest(F.col("marks")).alias("fingerprint"),
        digest(F.col("edited_marks")).alias("edited_fingerprint"), likeness(own, hashes(F.col("edited_marks"))).alias("near_edited"),
        likeness(own, hashes(F.col("next_marks"))).alias("near_next"), F.size("marks").alias("n_marks"))
