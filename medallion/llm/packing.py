"""Best-fit packing of token sequences, in bulk supersteps over sizes.

Documents are range-sorted by length; pieces of one length follow each other in rank, and so do bins with equal
gaps.  A superstep takes all pieces of the longest length that waits, sweeps the gaps upward from it (each gap's
successor is the smallest that fits), settles which piece gets which bin by rank, and puts the narrowed gaps back;
where no gap fits, new bins open.  Its state are runs of equal gaps: no more than a few for each length there can
be, whatever the number of documents.  So the sweep holds a bounded table, and documents only take part in the
range-sort that ranks them, in the histogram of lengths, and in the map that turns ranks into places.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.common import arrow_map, running_start, stored, table
from medallion.llm.registry import query
from medallion.llm.tokens import TOKENIZER, encoded

CAPACITY, END = 2048, 0
PIECE = "doc_id long, piece int, start long, length int, ids_crc32 long"


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """Pieces of every document: its ids and one end id, cut every ``capacity`` ids."""
    def cut(batch: pa.RecordBatch) -> pa.Table:
        rows, place, start, length, crc = [], [], [], [], []
        for row, ids in enumerate(encoded(batch.column("text"), tokenizer)):
            ids = np.append(ids, ids.dtype.type(END)).astype("<u4")
            for n, at in enumerate(range(0, len(ids), capacity)):
                part = ids[at:at + capacity]
                rows.append(row)
                place.append(n)
                start.append(at)
                length.append(len(part))
                crc.append(zlib.crc32(part.tobytes()))
        return pa.table({"doc_id": batch.column("doc_id").take(pa.array(rows, pa.int64())), "piece": pa.array(place, pa.int32()),
                         "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int32()), "ids_crc32": pa.array(crc, pa.int64())})

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), cut, PIECE)


def plan(lengths: dict[int, int], capacity: int) -> np.ndarray:
    """Where runs of equal pieces go: rows of length, first rank within it, pieces, pieces a bin, first bin, offset.

    ``lengths`` counts the pieces of each length.
    """
    rooms: list[int] = []                           # gaps that bins have, ascending
    runs: dict[int, list[tuple[int, int]]] = {}     # gap: first bin and number of bins of each run
    moves, opened = [], 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in runs:
                runs[room] = []
                insort(rooms, room)
            runs[room].append((first, n))

    for length in sorted(lengths, reverse=True):
        rank, left = 0, lengths[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = runs[room].pop()
                if not runs[room]:
                    del runs[room], rooms[at]
            else:
                room, first, n = capacity, opened, -(-left // (capacity // length))
                opened += n
            each = room // length
            taken = min(left, n * each)
            full, over = divmod(taken, each)
            moves.append((length, rank, taken, each, first, capacity - room))
            put(room - each * length, first, full)
            put(room - over * length, first + full, 1 if over else 0)
            put(room, first + full + bool(over), n - full - bool(over))
            rank, left = rank + taken, left - taken
    return np.array(moves, np.int64).reshape(-1, 6)


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``found`` (pieces with a positive ``length`` of at most ``capacity``) with ``sequence_id`` and ``offset``."""
    # stored first: the range-sort reads it twice
    ranked = stored(running_start(stored(found), [F.desc("length"), "doc_id", "piece", "ids_crc32"], F.lit(1), "_rank"))
    # at most ``capacity`` rows
    counts = {r["length"]: r["count"] for r in ranked.groupBy("length").count().collect()}
    moves = plan(counts, capacity)
    firsts = np.zeros(capacity + 2, np.int64)
    for length in range(capacity, 0, -1):
        firsts[length - 1] = firsts[length] + counts.get(length, 0)
    # rank over all pieces of each move's first piece; moves follow the order of ranks
    begins = firsts[moves[:, 0]] + moves[:, 1]
    shared = ranked.sparkSession.sparkContext.broadcast((begins, moves))

    def place(batch: pa.RecordBatch) -> pa.Table:
        begins, moves = shared.value
        rank = batch.column("_rank").to_numpy()
        move = np.searchsorted(begins, rank, "right") - 1
        within = rank - begins[move]
        length, each = moves[move, 0], moves[move, 3]
        kept = pa.Table.from_batches([batch]).drop_columns(["_rank"])
        return kept.append_column("sequence_id", pa.array(moves[move, 4] + within // each)).append_column(
            "offset", pa.array(moves[move, 5] + within % each * length))

    return arrow_map(ranked, place, f"{PIECE}, sequence_id long, offset long")


def packed(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """Pieces of all rows of ``docs`` (``doc_id`` long, ``text``) and their places in sequences of ``capacity``.

    Null and empty texts are one end id.  Repeated rows are packed each; ties go by id, piece and checksum.
    """
    return pack(pieces(docs, capacity, tokenizer), capacity).withColumn("length", F.col("length").cast("long"))


@query()
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
