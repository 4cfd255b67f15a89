"""What the operators share: scratch tables, running sums, and hashing of whole Arrow columns.

Conventions of all operators: a null text counts as an empty one, columns other than those named are ignored
(so extra columns cannot clash), repeated rows are kept as rows of their own unless the operator says otherwise,
and an empty table gives an empty result with the same schema.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medallion.session import shared_dir

WORD = r"[^\x20\x09-\x0D]+"
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Texts are worked on in runs of about this many bytes, so that arrays stay small whatever a batch holds.
RUN_BYTES = 1 << 20
# A document may be longer; batches that Spark hands over are held to this.
BATCH_BYTES = 16 << 20

_scratch: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, unless PYTHONPATH says that they have it."""
    root, context = Path(__file__).resolve().parents[2], spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(":") or getattr(context, "_medallion_sent", False):
        return
    # The driver serves this file to the executors as long as it runs.
    with zipfile.ZipFile(f"{tempfile.mkdtemp(prefix='medallion-code-')}/medallion_code.zip", "w") as held:
        for path in sorted(root.glob("medallion/**/*.py")):
            held.write(path, path.relative_to(root))
    context.addPyFile(held.filename)
    context._medallion_sent = True


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the bytes of a batch that goes to Python, unless the user has set it; see also ``ship_code``."""
    ship_code(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))
    return spark


def scratch_path(spark: SparkSession) -> str:
    """A new folder among the cluster's shared ones."""
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def stored(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_mark() -> int:
    return len(_scratch)


def scratch_since(mark: int) -> list[str]:
    """Scratch folders made since a mark."""
    return _scratch[mark:]


def drop_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch folders whose results have been written elsewhere."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def lower_ascii(text):
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def words(text):
    """Words of a column; none for a null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), F.lit(1))


def crc_mod(doc_id, n: int):
    """crc32 of the id as text, modulo n; 0 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0))


def running_start(df: DataFrame, order: list, value, out: str) -> DataFrame:
    """Sum of ``value`` over all rows before a row in the given order, as a long.

    Rows are range-sorted and stored with their range; the ranges' totals, one row each, are summed up and
    joined back, and inside a range a window runs.  ``order`` should be total; rows equal in it take any order.
    """
    ranged = stored(df.withColumn("_v", F.coalesce(value.cast("long"), F.lit(0)))
                    .repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range").agg(F.sum("_v").alias("_t"))
    totals = totals.select("_range", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (ranged.join(F.broadcast(totals), "_range")  # a row for each range
            .withColumn(out, F.col("_base") + F.coalesce(F.sum("_v").over(inside), F.lit(0)))
            .drop("_range", "_v", "_base"))


# ---- Arrow and numpy ------------------------------------------------------------------------------------------

U = np.uint64
GOLDEN = U(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, np.uint64)


def flags(chars: bytes) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(chars)] = True
    return found


SPACE = flags(b" \t\n\x0b\x0c\r")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CONTINUES = (np.arange(256) & 0xC0) == 0x80  # bytes that start no code point


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finish, a bijection on 64 bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(n: int) -> np.ndarray:
    """Powers of an odd number modulo 2**64."""
    global _POWERS
    if len(_POWERS) < n:
        size = max(n, 2 * len(_POWERS), 4096)
        with np.errstate(over="ignore"):
            _POWERS = np.cumprod(np.concatenate([[U(1)], np.full(size - 1, U(0xD6E8FEB86659FD93))]), dtype=np.uint64)
    return _POWERS


def text_runs(column: pa.Array, run_bytes: int = RUN_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of a text column: first row, end row, their UTF-8 bytes, and where each text begins and ends.

    Only the last text of a run may take it over ``run_bytes``.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(offsets, offsets[first] + run_bytes, "left"))
        end = min(max(end, first + 1), len(column))
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def spans(gap: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and (per text, one more) first index of the runs of bytes that are not gaps."""
    n = len(gap)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~gap
    start = inside.copy()
    start[1:] &= gap[:-1]
    heads = offsets[:-1][offsets[:-1] < n]
    start[heads] = inside[heads]
    stop = inside.copy()
    stop[:-1] &= gap[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    stop[tails] = inside[tails]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(stop) + 1, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes; spans must be ordered, apart and not empty."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    firsts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
    held = data[np.repeat(starts, lengths) + place].astype(np.uint64)
    held += U(1)
    held *= powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(held, firsts) ^ (lengths.astype(np.uint64) * GOLDEN))


def gram_hashes(hashes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-grams of items, and the index of each gram's first item; none crosses a text's bound."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total = total * U(0xD6E8FEB86659FD93) + hashes[i:i + n]
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    whole = np.flatnonzero(text[:n] == text[k - 1:])
    return mix(total[whole]), whole


_caches: list = []
_last_kind: list[str] = [""]


def kept(cached):
    """Register what a worker process keeps from task to task (a ``lru_cache``)."""
    _caches.append(cached)
    return cached


def begin_task(kind: str) -> None:
    """Drop what tasks of another kind have kept: a process serves one kind after another, and memory is bounded."""
    if _last_kind[0] != kind:
        for cached in _caches:
            cached.cache_clear()
    _last_kind[0] = kind


def arrow_map(df: DataFrame, work, schema: str) -> DataFrame:
    """``mapInArrow`` over record batches; ``work`` gives a table or None for each batch."""
    kind = f"{work.__module__}.{work.__qualname__}"

    def each(batches):
        begin_task(kind)
        for batch in batches:
            if batch.num_rows and (found := work(batch)) is not None:
                yield from found.to_batches() if isinstance(found, pa.Table) else [found]

    prepare(df.sparkSession)
    return df.mapInArrow(each, schema)
