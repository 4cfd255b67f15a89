"""Document log-likelihoods under a gated recurrent language model, beside a counted unigram base.

1. Words of all training texts are counted, by 64-bit hashes.
2. The commonest words are the network's head symbols; all others fall into tail classes by their first byte, and
   within a class a word has its add-one share of the class's counts (as in the base, all unseen words are one).
3. The network is trained by truncated backpropagation in rounds: every training document belongs to one round, and
   is dealt to one of its trainers, more of them for more words; their weights are averaged by tokens.
4. Every text is scored whole, documents side by side in lanes, with the state carried across windows.  Counts of
   frequent words come from a table of bounded size; those of all other words through a join.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm import gru
from medallion.llm.common import LOWER, SPACE, U, arrow_map, crc_mod, span_hashes, spans, stored, table, text_runs
from medallion.llm.registry import query

# Words whose counts every task holds at most (16 bytes each); all others are joined.
FREQUENT = 1 << 19
SLOT_BITS = 21
# Rounds that the training documents are dealt over; tokens a trainer takes, on average at most.
ROUNDS, TRAINER_TOKENS = 2, 2_000_000
# Groups in which a round's weights are averaged, at least; the square root of the trainers if they are more.
MERGERS = 32

# First byte of a lower-cased word: letters, digits, four kinds of lead bytes, all else.
_TAIL = np.full(256, 31, np.uint8)
_TAIL[97:123] = np.arange(26)
_TAIL[48:58] = 26
_TAIL[0xC2:0xC4], _TAIL[0xC4:0xD0], _TAIL[0xD0:0xE0], _TAIL[0xE0:0xF8] = 27, 28, 29, 30


def hashed_words(column: pa.Array):
    """For runs of texts: word hashes, their tail classes, words of each text."""
    with np.errstate(over="ignore"):
        for _, _, data, offsets in text_runs(column):
            data = LOWER[data]
            starts, ends, bounds = spans(SPACE[data], offsets)
            yield span_hashes(data, starts, ends), _TAIL[data[starts]], np.diff(bounds)


def counts(docs: DataFrame) -> DataFrame:
    """``word`` (hash), ``tail``, ``n`` over whole texts; ends are not in it."""
    def count(batch: pa.RecordBatch) -> pa.Table:
        runs = list(hashed_words(batch.column("text")))
        words, first, n = np.unique(np.concatenate([r[0] for r in runs]), return_index=True, return_counts=True)
        tails = np.concatenate([r[1] for r in runs])[first]
        return pa.table({"word": words.view(np.int64), "tail": tails.astype(np.int8), "n": n})

    found = arrow_map(docs.select("text"), count, "word long, tail byte, n long")
    return found.groupBy("word").agg(F.max("tail").alias("tail"), F.sum("n").alias("n"))


class Lexicon:
    """Head symbols and the bounded table of frequent words; the same in every task."""

    def __init__(self, words: np.ndarray, tails: np.ndarray, n: np.ndarray):
        order = np.lexsort((words, -n))
        words, tails, n = words[order], tails[order], n[order]
        self.words, self.tails, self.logs = words, tails, np.log10(n + 1.0).astype(np.float64)
        self.n_head = min(len(words), gru.HEAD - 1)
        self.slots = None

    def __getstate__(self):
        return {**self.__dict__, "slots": None}

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each word is in the table, and where; words that share a slot with a commoner one are not."""
        if self.slots is None:
            slots = np.full(1 << SLOT_BITS, -1, np.int32)
            place = (self.words >> U(64 - SLOT_BITS)).astype(np.int64)
            slots[place[::-1]] = np.arange(len(place) - 1, -1, -1, dtype=np.int32)
            self.slots = slots
        at = self.slots[(hashes >> U(64 - SLOT_BITS)).astype(np.int64)]
        return (at >= 0) & (self.words[np.maximum(at, 0)] == hashes) if len(self.words) else at >= 0, at

    def symbols(self, hashes: np.ndarray, tails: np.ndarray, known: np.ndarray, at: np.ndarray) -> np.ndarray:
        head = known & (at < self.n_head)
        return np.where(head, at + 1, gru.HEAD + tails.astype(np.int64))


def in_order(symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents in the order of their content, which does not depend on the order they came in."""
    counts = sizes - 1  # the end of a document is no symbol
    ends = np.cumsum(counts)
    order = sorted(range(len(sizes)), key=lambda i: (zlib.crc32(symbols[ends[i] - counts[i]:ends[i]].tobytes()), counts[i]))
    first, counts = (ends - counts)[order], counts[order]
    place = np.arange(int(counts.sum())) + np.repeat(first - (np.cumsum(counts) - counts), counts)
    return symbols[place], sizes[order]


def learn(docs: DataFrame, lexicon: Lexicon, params: dict, tokens: int) -> dict:
    """Rounds of trainers over all of ``docs``; ``tokens`` of their texts set how many trainers there are."""
    spark = docs.sparkSession
    trainers = max(1, math.ceil(tokens / ROUNDS / TRAINER_TOKENS))
    mergers = max(MERGERS, math.isqrt(trainers))
    key = F.pmod(F.xxhash64("doc_id", F.lit("learn")), F.lit(ROUNDS))
    shapes = {k: v.shape for k, v in params.items()}
    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast((lexicon, params))

        def work(batches):
            words, params = shared.value
            symbols, sizes = [], []
            for batch in batches:
                for hashes, tails, n in hashed_words(batch.column("text")):
                    symbols.append(words.symbols(hashes, tails, *words.look_up(hashes)))
                    sizes.append(n + 1)
            if sizes:
                sizes = np.concatenate(sizes)
                got = gru.train(params, *in_order(np.concatenate(symbols), sizes))
                yield pa.record_batch({"weights": pa.array([gru.pack(got)], pa.binary()), "tokens": pa.array([int(sizes.sum())])})

        def merge(group: pa.Table) -> pa.Table:
            rows = sorted(zip(group.column("tokens").to_pylist(), group.column("weights").to_pylist(), strict=True))
            n = np.array([t for t, _ in rows], float)
            held = sum(w * np.frombuffer(x, np.float32) for w, (_, x) in zip(n / n.sum(), rows, strict=True))
            return pa.table({"weights": pa.array([held.astype(np.float32).tobytes()], pa.binary()), "tokens": pa.array([int(n.sum())])})

        kind = "weights binary, tokens long"
        got = docs.where(key == turn).select("text").repartition(trainers).mapInArrow(work, kind)
        got = got.withColumn("m", F.pmod(F.monotonically_increasing_id() + F.spark_partition_id(), F.lit(mergers)))
        got = got.groupBy("m").applyInArrow(merge, kind)
        if mergers > MERGERS:  # many trainers: the driver gets MERGERS rows, however many there are
            got = got.withColumn("m", F.pmod(F.xxhash64("weights"), F.lit(MERGERS))).groupBy("m").applyInArrow(merge, kind)
        rows = got.collect()
        if rows:
            total = sum(r["tokens"] for r in rows)
            flat = sum(np.frombuffer(r["weights"], np.float32) * (r["tokens"] / total) for r in sorted(rows, key=lambda r: (r["tokens"], r["weights"])))
            params = gru.unpack(flat.astype(np.float32).tobytes(), {k: np.zeros(s, np.float32) for k, s in shapes.items()})
    return params


def score_documents(docs: DataFrame) -> DataFrame:
    """Contract columns for every row of ``docs`` (``doc_id``, ``text``), learned from rows with crc32 mod 7 not 2.

    Null and empty texts are one end token.  Without training rows all words are unknown and the network is that
    of equal chances.  Repeated rows count and are scored each.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    held_out = crc_mod(F.col("doc_id"), 7) == 2
    training = docs.where(~held_out)
    counted = stored(counts(training))
    n_docs = training.count()
    per_tail = {r["tail"]: (r["n"], r["v"]) for r in counted.groupBy("tail").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    total, distinct = n_docs + sum(n for n, _ in per_tail.values()), (n_docs > 0) + sum(v for _, v in per_tail.values())
    # the least count of a table of at most FREQUENT words
    sizes = counted.groupBy(F.least("n", F.lit(1 << 16)).alias("n")).count().orderBy(F.desc("n")).collect()
    least, held = (1 << 16) + 1, 0
    for r in sizes:
        held += r["count"]
        if held > FREQUENT:
            break
        least = r["n"]
    got = counted.where(F.col("n") >= least).toArrow()
    words = got.column("word").to_numpy().view(np.uint64)
    lexicon = Lexicon(words, got.column("tail").to_numpy(), got.column("n").to_numpy())
    head_n = np.zeros(gru.HEAD)
    head_n[0] = n_docs
    head_n[1:lexicon.n_head + 1] = np.rint(10 ** lexicon.logs[:lexicon.n_head] - 1)
    in_head = np.bincount(lexicon.tails[:lexicon.n_head], head_n[1:lexicon.n_head + 1], gru.TAILS)
    v_head = np.bincount(lexicon.tails[:lexicon.n_head], minlength=gru.TAILS)
    tail_n = np.array([per_tail.get(i, (0, 0))[0] for i in range(gru.TAILS)]) - in_head
    tail_v = np.array([per_tail.get(i, (0, 0))[1] for i in range(gru.TAILS)]) - v_head
    base_log, tail_logs, end_log = math.log10(total + distinct + 1), np.log10(tail_n + tail_v + 1), math.log10(n_docs + 1)

    params = learn(training, lexicon, gru.initial(head_n, tail_n), total)
    shared = spark.sparkContext.broadcast((lexicon, params))

    def rate(batch: pa.RecordBatch) -> pa.Table:
        lexicon, params = shared.value
        symbols, sizes, out, rare_words, rare_rows, rare_n, row = [], [], [], [], [], [], 0
        for hashes, tails, n in hashed_words(batch.column("text")):
            known, at = lexicon.look_up(hashes)
            ids = lexicon.symbols(hashes, tails, known, at)
            of = np.repeat(np.arange(len(n)), n)
            logs = np.where(known, lexicon.logs[np.maximum(at, 0)], 0.0) if len(lexicon.logs) else np.zeros(len(ids))
            tail = ids >= gru.HEAD
            below = np.where(tail, logs - tail_logs[tails], 0.0)
            out.append(np.stack([np.bincount(of, w, len(n)) for w in (known.astype(float), logs, below)]))
            symbols.append(ids)
            sizes.append(n + 1)
            odd = np.flatnonzero(~known)
            rare_words.append(hashes[odd])
            rare_rows.append(of[odd] + row)
            row += len(n)
        symbols, sizes, out = np.concatenate(symbols), np.concatenate(sizes), np.concatenate(out, axis=1)
        model = gru.score(params, symbols, sizes) / math.log(10)
        rare_words, rare_rows = np.concatenate(rare_words), np.concatenate(rare_rows)
        ends = np.searchsorted(rare_rows, np.arange(len(sizes) + 1)).astype(np.int32)
        return pa.table({
            "row": batch.column("row"), "doc_id": batch.column("doc_id"), "n_tokens": sizes.astype(np.int64),
            "n_known": (out[0] + (n_docs > 0)).astype(np.int64), "logs": out[1] + end_log, "score": model + out[2],
            "rare": pa.ListArray.from_arrays(ends, rare_words.view(np.int64))})

    scored = stored(arrow_map(docs.withColumn("row", F.monotonically_increasing_id()), rate,
                              "row long, doc_id long, n_tokens long, n_known long, logs double, score double, rare array<long>"))
    rare = scored.select("row", F.explode("rare").alias("word")).groupBy("row", "word").agg(F.count("*").alias("times"))
    rare = (rare.join(counted.where(F.col("n") < least if len(sizes) else F.lit(True)).select("word", "n")
                      .union(_crowded(counted, lexicon, least)), "word")
            .groupBy("row").agg(F.sum("times").alias("found"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more")))
    # 0 for rare words that training has not seen: log10(0 + 1)
    found, more = F.coalesce("found", F.lit(0)), F.coalesce("more", F.lit(0.0))
    return scored.join(rare, "row", "left").select(
        "doc_id", (crc_mod(F.col("doc_id"), 7) == 2).alias("held_out"), "n_tokens", (F.col("n_known") + found).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), (F.col("logs") + more - F.col("n_tokens") * base_log).alias("base_score"),
        (F.col("score") + more).alias("score"))


def _crowded(counted: DataFrame, lexicon: Lexicon, least: int) -> DataFrame:
    """Frequent words that lost their slot to a commoner one, with their counts."""
    known, _ = lexicon.look_up(lexicon.words)
    lost = pa.table({"word": lexicon.words[~known].view(np.int64)})
    # at most FREQUENT rows
    return counted.join(F.broadcast(counted.sparkSession.createDataFrame(lost)), "word", "left_semi").select("word", "n")


@query()
def op9_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
