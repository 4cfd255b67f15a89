"""Mixing sources to target weights, exactly to the word.

Documents get hash-random keys, are range-sorted by source and key, and distributed prefix sums of their sizes
say where each lies in its source.  A source's budget cuts that order: whole epochs first, then the documents up to
the cut, the last of which gives only a part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medallion.llm.common import WORD, running_start, stored, table
from medallion.llm.registry import query

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2
SEED = "mix-1"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, before, target`` from ``source, source_size``, one row for each source.

    Weights repeat over the sources in code-point order, null last.  Targets share ``SHARE`` of all sizes by
    weight; those that would exceed ``MOST`` times their source stop there and the others share the rest, which
    is a common level times the weight.  The table has a row for each source, so its windows are one task's work.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1)
    table = (sizes.withColumn("weight", weight).withColumn("most", MOST * F.col("source_size"))
             .withColumn("before", F.sum("source_size").over(by_name) - F.col("source_size"))
             .withColumn("total", SHARE * F.sum("source_size").over(everything)))
    by_level = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source")
    table = (table.withColumn("stopped", F.sum("most").over(by_level) - F.col("most"))
             .withColumn("open", F.sum("weight").over(Window.orderBy(F.desc(F.col("most") / F.col("weight")), F.desc(F.col("source").isNull()), F.desc("source"))))
             .withColumn("level", (F.col("total") - F.col("stopped")) / F.col("open")))
    # the first source, in order of the level it would stop at, that its level does not reach
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct(F.col("most") / F.col("weight"), "level"))).over(everything)
    table = table.withColumn("level", level["level"])
    return table.select("source", "source_size", "before", F.when(
        F.col("level").isNull() | (F.col("level") * F.col("weight") > F.col("most")), F.col("most").cast("double"))
        .otherwise(F.col("level") * F.col("weight")).alias("target"))


def mix(docs: DataFrame, carry: Column | None = None) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` (and ``row``, if ``carry`` names a column) of every row.

    ``docs`` has ``doc_id, text, source``; a null text has size 0.  ``taken`` counts the words that the mix takes
    of a document, repeats counted; it is at most ``MOST`` times the size, and a source's sum is its target less
    a part of a word.  Repeated rows count each; ties of key and id take any order, which no sum depends on.
    """
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), *([carry.alias("row")] if carry is not None else []))
    key = F.substring(F.md5(F.concat_ws(":", F.lit(SEED), F.col("doc_id").cast("string"))), 1, 16)
    order = [F.col("source").isNull(), F.col("source"), F.col("key"), F.col("doc_id"), F.col("size")]
    placed = running_start(sized.withColumn("key", key), order, F.col("size"), "start").drop("key")
    share = stored(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))))
    found = placed.join(share.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    budget = F.floor("target")
    epochs = F.coalesce(F.floor(budget / F.col("source_size")), F.lit(0)).cast("long")
    rest = budget - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - (F.col("start") - F.col("before"))))
    return found.withColumn("taken", (epochs * F.col("size") + part).cast("long")).drop("start", "before")


def mixed_rows(docs: DataFrame) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each time that a document is taken.

    A document cut by its source's budget ends behind its last word that is taken.
    """
    found = mix(docs, F.struct(*docs.columns)).where("taken > 0").select("row", "size", "taken")
    copies = F.floor(F.col("taken") / F.col("size")).cast("int")
    rest = (F.col("taken") % F.col("size")).cast("int")
    sizes = F.concat(F.when(copies > 0, F.array_repeat(F.col("size").cast("int"), copies)).otherwise(F.array()),
                     F.when(rest > 0, F.array(rest)).otherwise(F.array()))
    found = found.withColumn("take", F.explode(sizes))
    pieces = F.regexp_extract_all("row.text", F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), F.lit(1))
    text = F.when(F.col("take") < F.col("size"), F.array_join(F.slice(pieces, F.lit(1), F.col("take")), "")).otherwise(F.col("row.text"))
    fixed = {"text": text}
    if "n_chars" in docs.columns:
        fixed["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return found.select(*[fixed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         substr(md5('mix-1:' || doc_id::VARCHAR), 1, 16) AS key FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
         2 * source_size AS most, 1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE AS total FROM sums),
levels AS (SELECT *, most::DOUBLE / weight AS stops,
         (total - (sum(most) OVER up - most)::DOUBLE) / (sum(weight) OVER down)::DOUBLE AS level FROM weighed
         WINDOW up AS (ORDER BY most::DOUBLE / weight, source NULLS LAST), down AS (ORDER BY most::DOUBLE / weight DESC, source DESC NULLS FIRST)),
found AS (SELECT level FROM levels WHERE level * weight <= most ORDER BY stops, level LIMIT 1),
shares AS (SELECT source, source_size, CASE WHEN f.level IS NULL OR f.level * weight > most THEN most::DOUBLE ELSE f.level * weight END AS target
         FROM levels LEFT JOIN found f ON true),
placed AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start FROM sized),
cut AS (SELECT doc_id, size, start, source_size, target, floor(target)::BIGINT AS budget,
         CASE WHEN source_size = 0 THEN 0 ELSE floor(target)::BIGINT // source_size END AS epochs
         FROM placed p JOIN shares s ON p.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, budget - epochs * source_size - start)))::BIGINT AS taken FROM cut
"""


@query(ORACLE)
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
