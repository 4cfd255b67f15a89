"""The corpus pipeline: toxic documents go, one of each near-duplicate group stays, secrets are masked, sources are
mixed to their weights, and the mix is packed into sequences.

Each stage takes the whole result of the one before, as Parquet.  A document that the mix takes twice is two rows
from there on.  No SQL states the toxicity model or the forest, so ``ORACLE_SQL`` is None and the stages are
tested against brute force.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from medallion.llm.common import drop_paths, prepare, scratch_mark, scratch_since, stored, table
from medallion.llm.hamming_dedup import keep_one
from medallion.llm.mixing import mixed_rows
from medallion.llm.packing import packed
from medallion.llm.secrets import redact
from medallion.llm.toxicity import drop_toxic

ORACLE_SQL = None

_left: list[str] = []


def _stage(work):
    """A stage whose predecessor's scratch tables go when it begins: that one's result has been written by then."""
    @functools.wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark)
        drop_paths(spark, _left)
        _left.clear()
        mark = scratch_mark()
        result = work(spark, docs, sf_dir)
        _left.extend(scratch_since(mark))
        return result

    return run_stage


@_stage
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows not predicted toxic by a model learned from the labels of these documents."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose document has the smallest id of its near-duplicates."""
    return keep_one(docs)


@_stage
def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with secrets masked."""
    return redact(docs, path="source")


@_stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix takes a document; the last of a source may be cut."""
    return mixed_rows(docs)


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the rows and their places in sequences."""
    return packed(docs)


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("secret_scan", secret_scan), ("mixing", mixing),
          ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(prepare(spark), sf_dir, "documents"), []
    for _, stage in STAGES[:-1]:
        mark = scratch_mark()
        docs = stored(stage(spark, docs, sf_dir))
        drop_paths(spark, before)
        before = scratch_since(mark)[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
