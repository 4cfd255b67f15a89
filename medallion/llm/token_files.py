"""Token ids of a corpus in files of independent blocks, coded by a range asymmetric numeral system.

A folder holds two Parquet tables, since only Spark's own writers reach every store: ``table``, the corpus's token
counts that all blocks share, and ``blocks``, rows of ``start`` (ids of all documents before), the documents'
ids and lengths, and the block's bytes (see ``rans``).  Blocks hold whole documents in ascending order.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medallion.llm import rans
from medallion.llm.common import arrow_map, begin_task, prepare, scratch_path, stored, table
from medallion.llm.registry import query
from medallion.llm.tokens import TOKENIZER, encoded

END = 2
# A block is closed once it holds this many ids; a longer document is a block of its own.
BLOCK_IDS = 1 << 20
BLOCKS = "part int, local long, doc_ids array<long>, lengths array<long>, block binary"


def tokenized(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """``part, local, doc_id, ids``: range-sorted by id (then text), ``local`` counts the ids before in the part."""
    def work(batches):
        begin_task("tokenized")
        part, local = TaskContext.get().partitionId(), 0
        for batch in batches:
            held, starts = [], []
            for ids in encoded(batch.column("text"), tokenizer):
                held.append(ids.tobytes() + ids.dtype.type(END).tobytes())
                starts.append(local)
                local += len(ids) + 1
            yield pa.record_batch({"part": pa.array([part] * len(held), pa.int32()), "local": pa.array(starts, pa.int64()),
                                   "doc_id": batch.column("doc_id"), "width": pa.array([ids.dtype.itemsize] * len(held), pa.int32()),
                                   "ids": pa.array(held, pa.binary())})

    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id")
    return rows.sortWithinPartitions("doc_id", "text").mapInArrow(work, "part int, local long, doc_id long, width int, ids binary")


def _ids(held: bytes, width: int) -> np.ndarray:
    return np.frombuffer(held, f"<u{width}")


def write(docs: DataFrame, path: str, tokenizer: str = TOKENIZER) -> None:
    """Encode all rows of ``docs`` (``doc_id`` long, ``text``) into a new folder.

    A null text counts as empty; each document ends with the end id.  Rows that repeat an id follow each other.
    """
    spark = docs.sparkSession
    rows = stored(tokenized(docs, tokenizer))

    def count(batch: pa.RecordBatch) -> pa.Table:
        joined = np.concatenate([_ids(x.as_py(), w.as_py()) for x, w in zip(batch.column("ids"), batch.column("width"), strict=True)])
        n = np.bincount(joined)
        seen = np.flatnonzero(n)
        return pa.table({"id": seen.astype(np.int64), "n": n[seen].astype(np.int64)})

    counts = arrow_map(rows.select("ids", "width"), count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts.coalesce(1).write.parquet(f"{path}/table")  # a row for each id of the vocabulary
    shared = spark.sparkContext.broadcast(read_table(spark, path))

    def pack(batches):
        codec, part, local, docs, held, size = shared.value, None, 0, [], [], 0

        def closed():
            joined = np.concatenate(held)
            return pa.record_batch({
                "part": pa.array([part], pa.int32()), "local": pa.array([local], pa.int64()), "doc_ids": pa.array([docs], pa.list_(pa.int64())),
                "lengths": pa.array([[len(x) for x in held]], pa.list_(pa.int64())), "block": pa.array([rans.encode(joined, codec)], pa.binary())})

        for batch in batches:
            for p, at, doc, width, ids in zip(*(batch.column(c).to_pylist() for c in ("part", "local", "doc_id", "width", "ids")), strict=True):
                if held and (p != part or at != local + size or size >= BLOCK_IDS):
                    yield closed()
                    docs, held, size = [], [], 0
                if not held:
                    part, local = p, at
                held.append(_ids(ids, width))
                docs.append(doc)
                size += len(held[-1])
        if held:
            yield closed()

    blocks = rows.mapInArrow(pack, BLOCKS)
    sizes = rows.groupBy("part").agg(F.max(F.col("local") + F.length("ids") / F.col("width")).cast("long").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))  # a row for each part
    (blocks.join(F.broadcast(base), "part").select((F.col("base") + F.col("local")).alias("start"), "doc_ids", "lengths", "block")
     .write.option("compression", "none").parquet(f"{path}/blocks"))


def read_table(spark: SparkSession, path: str) -> rans.Table:
    rows = spark.read.parquet(f"{path}/table").toArrow()  # a row for each id of the vocabulary
    ids, n = rows.column("id").to_numpy(), rows.column("n").to_numpy()
    counts = np.zeros(int(ids.max()) + 1 if len(ids) else 0, np.int64)
    counts[ids] = n
    return rans.Table(counts)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids`` of every document in a folder, ``ids`` as little-endian unsigned 32-bit numbers."""
    shared = spark.sparkContext.broadcast(read_table(spark, path))

    def unpack(batch: pa.RecordBatch) -> pa.Table:
        docs, starts, held = [], [], []
        for start, ids, lengths, block in zip(*(batch.column(c).to_pylist() for c in ("start", "doc_ids", "lengths", "block")), strict=True):
            decoded = rans.decode(block, shared.value)
            ends = np.cumsum([0, *lengths])
            for doc, a, b in zip(ids, ends[:-1], ends[1:], strict=True):
                docs.append(doc)
                starts.append(start + int(a))
                held.append(decoded[a:b].astype("<u4").tobytes())
        return pa.table({"doc_id": pa.array(docs, pa.int64()), "start": pa.array(starts, pa.int64()), "ids": pa.array(held, pa.binary())})

    return arrow_map(spark.read.parquet(f"{path}/blocks"), unpack, "doc_id long, start long, ids binary")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone."""
    shared = spark.sparkContext.broadcast(read_table(spark, path))

    def check(batch: pa.RecordBatch) -> pa.Table:
        docs, starts, sizes, crcs = [], [], [], []
        for start, ids, lengths, block in zip(*(batch.column(c).to_pylist() for c in ("start", "doc_ids", "lengths", "block")), strict=True):
            decoded = rans.decode(block, shared.value).astype("<u4")
            ends = np.cumsum([0, *lengths])
            docs += ids
            starts += (start + ends[:-1]).tolist()
            sizes += lengths
            crcs += [zlib.crc32(decoded[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return pa.table({"doc_id": pa.array(docs, pa.int64()), "start": pa.array(starts, pa.int64()),
                         "n_tokens": pa.array(sizes, pa.int64()), "ids_crc32": pa.array(crcs, pa.int64())})

    return arrow_map(spark.read.parquet(f"{path}/blocks"), check, "doc_id long, start long, n_tokens long, ids_crc32 long")


@query()
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark)
    write(table(spark, sf_dir, "documents"), path)
    return digests(spark, path)
