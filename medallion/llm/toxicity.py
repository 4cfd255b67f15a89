"""Toxicity by multiple-instance learning: sentence scores, joined by a noisy-or, learned from document labels.

A document is a bag of sentences.  A sentence is toxic with probability sigmoid(bias + weights of its words and
of their beginnings, which inflected and compound words share);
a document is toxic unless every sentence, and a leak that stands for all else, fails to make it so.  Only
documents carry labels, so the gradient of the document's likelihood decides which sentences take the blame.
After training, the sentences' own probabilities locate the offending ones.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.common import CONTINUES, LOWER, U, arrow_map, crc_mod, flags, mix, span_hashes, spans, stored, table, text_runs
from medallion.llm.registry import query

BUCKET_BITS = 21
# Bound of the labelled sample that the classifier is fitted on (documents, chosen by a hash of their id).
MAX_TRAIN_DOCS = 16_384
EPOCHS, BATCH_DOCS, RATE, DECAY = 10, 64, 0.1, 2e-5
# Features of fewer documents of the sample get no weight, else rare words would take the blame.
LEAST_DOCS = 8
# Bytes of a word's beginnings that count as features beside the word.
BEGINNINGS = (3, 4, 5, 6)
FEATURES = 1 + len(BEGINNINGS)
OFFENDING = 0.5

_WORD_BYTES = bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
_GAP = ~flags(_WORD_BYTES)
_STOP = flags(b".!?\n")


def sentence_words(column: pa.Array):
    """For runs of texts: buckets of each word's features, first word of each sentence, sentences of each text, their spans.

    A word is a run of letters, digits and non-ASCII bytes, lower-cased; a sentence ends at . ! ? or a new line.
    Sentences without a word do not count.  Spans are in code points of the text.
    """
    for _, _, data, offsets in text_runs(column):
        starts, ends, bounds = spans(_GAP[data], offsets)
        stops = np.concatenate([[0], np.cumsum(_STOP[data])])
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
        sentence = stops[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (sentence[1:] != sentence[:-1]) | (doc[1:] != doc[:-1])
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(starts)) - 1 if len(heads) else heads
        with np.errstate(over="ignore"):
            low = LOWER[data]
            hashes = np.stack([span_hashes(low, starts, ends)] + [
                mix(span_hashes(low, starts, np.minimum(ends, starts + k)) + U(k)) for k in BEGINNINGS], axis=1)
        points = np.concatenate([[0], np.cumsum(~CONTINUES[data])])
        base = points[offsets[:-1]][doc[heads]]
        yield ((hashes >> U(64 - BUCKET_BITS)).astype(np.int32), heads, np.searchsorted(heads, bounds),
               points[starts[heads]] - base, points[ends[tails]] - base)


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def _bags(batch: pa.RecordBatch) -> pa.Table:
    """Word buckets and sentence lengths of labelled documents."""
    buckets, lengths = [], []
    for words, heads, cut, _, _ in sentence_words(batch.column("text")):
        ends = np.append(heads, len(words))
        for i in range(len(cut) - 1):
            own = ends[cut[i]:cut[i + 1] + 1]
            buckets.append(words[own[0]:own[-1]].ravel() if len(own) > 1 else words[:0].ravel())
            lengths.append(np.diff(own).astype(np.int32))
    return pa.table({"doc_id": batch.column("doc_id"), "toxic": batch.column("toxic"),
                     "buckets": pa.array(buckets, pa.list_(pa.int32())), "lengths": pa.array(lengths, pa.list_(pa.int32()))})


def fit(labels: np.ndarray, bags: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Weights of the word buckets, then the sentences' bias, then the leak; Adagrad on the noisy-or likelihood."""
    size = 1 << BUCKET_BITS
    weights, pace = np.zeros(size + 2), np.full(size + 2, 1e-6)
    # few sentences of a text are toxic; without a label none is
    weights[size:] = (-7.0, -3.0) if len(labels) else (-50.0, -50.0)
    seen = np.zeros(size, np.int32)
    for words, _ in bags:
        seen[np.unique(words)] += 1
    frequent = (seen >= LEAST_DOCS).astype(float)
    draw = np.random.default_rng(7)
    for _ in range(EPOCHS):
        order = draw.permutation(len(labels))
        for at in range(0, len(order), BATCH_DOCS):
            part = order[at:at + BATCH_DOCS]
            y = labels[part].astype(float)
            words = np.concatenate([bags[i][0] for i in part])
            lengths = np.concatenate([bags[i][1] for i in part]).astype(np.int64)
            counts = np.array([len(bags[i][1]) for i in part])
            sentence = np.repeat(np.arange(len(lengths)), FEATURES * lengths)
            doc = np.repeat(np.arange(len(part)), counts)
            z = weights[size] + np.bincount(sentence, weights[words], len(lengths))
            blame = np.bincount(doc, softplus(z), len(part)) + softplus(weights[size + 1])
            # -log likelihood is blame for a clean document and -log(1 - exp(-blame)) for a toxic one
            slope = np.where(y > 0, -1 / np.expm1(np.clip(blame, 1e-6, 500)), 1.0) / len(part)
            dz = slope[doc] / (1 + np.exp(-np.maximum(z, -50)))
            touched, place = np.unique(words, return_inverse=True)
            grad = (np.bincount(place, dz[sentence], len(touched)) + DECAY * weights[touched]) * frequent[touched]
            pace[touched] += grad**2
            weights[touched] -= RATE * grad / np.sqrt(pace[touched])
            for i, g in ((size, dz.sum()), (size + 1, slope.sum() / (1 + np.exp(-weights[size + 1])))):
                pace[i] += g**2
                weights[i] -= RATE * g / np.sqrt(pace[i])
    return weights


def train(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Weights learned from at most about ``MAX_TRAIN_DOCS`` labelled documents, hash-chosen, in one task.

    ``labels``: ``doc_id, toxic``; null labels are left out, an id with several labels is toxic if one says so.
    Without labels, weights say clean.
    """
    marks = (labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    n = marks.count()
    share = MAX_TRAIN_DOCS / max(n, MAX_TRAIN_DOCS)
    chosen = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < round(1_000_000 * share))
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
             .join(F.broadcast(chosen), "doc_id"))  # bound: MAX_TRAIN_DOCS rows of 12 bytes
    bags = arrow_map(texts, _bags, "doc_id long, toxic int, buckets array<int>, lengths array<int>")

    def learn(batches):
        ids, marks, held = [], [], []
        for batch in batches:
            ids += batch.column("doc_id").to_pylist()
            marks += batch.column("toxic").to_pylist()
            for b, n in zip(batch.column("buckets"), batch.column("lengths"), strict=True):
                held.append((b.values.to_numpy(zero_copy_only=False), n.values.to_numpy(zero_copy_only=False)))
        order = sorted(range(len(ids)), key=lambda i: (ids[i], len(held[i][0]), zlib.crc32(held[i][0])))
        found = fit(np.array([marks[i] for i in order]), [held[i] for i in order])
        yield pa.record_batch({"weights": pa.array([found.astype(np.float32).tobytes()], pa.binary())})

    # scan and features are work of all tasks; one task learns from the bounded sample that they have written
    row = stored(bags).coalesce(1).mapInArrow(learn, "weights binary").collect()
    return np.frombuffer(row[0][0], np.float32) if row else fit(np.zeros(0), []).astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id, score, offending`` of every row: noisy-or score, and sentences with a probability of 0.5 or more.

    ``offending`` holds ``start, end`` (code points of the text) and ``score`` in order of the text.
    A text without words scores the leak alone.
    """
    size = 1 << BUCKET_BITS
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 2**21 floats

    def rate(batch):
        w = shared.value
        scores, starts, ends, rates, counts = [], [], [], [], []
        for words, heads, cut, begin, end in sentence_words(batch.column("text")):
            z = w[size] + (np.add.reduceat(w[words].sum(axis=1, dtype=float), heads) if len(heads) else np.zeros(0))
            blame = np.concatenate([[0], np.cumsum(softplus(z))])
            scores.append(-np.expm1(-(blame[cut[1:]] - blame[cut[:-1]] + softplus(w[size + 1]))))
            p = 1 / (1 + np.exp(-np.maximum(z, -50)))
            bad = np.flatnonzero(p >= OFFENDING)
            starts.append(begin[bad])
            ends.append(end[bad])
            rates.append(p[bad])
            counts.append(np.diff(np.searchsorted(bad, cut)))
        spans = pa.StructArray.from_arrays(
            [pa.array(np.concatenate(starts).astype(np.int64)), pa.array(np.concatenate(ends).astype(np.int64)),
             pa.array(np.concatenate(rates))], ["start", "end", "score"])
        edges = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32)
        return pa.table({"doc_id": batch.column("doc_id"), "score": np.clip(np.concatenate(scores), 0, 1),
                         "offending": pa.ListArray.from_arrays(edges, spans)})

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), rate,
                     "doc_id long, score double, offending array<struct<start:long,end:long,score:double>>")


def learn_and_score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every row of ``docs``; rows with crc32(doc_id as text) mod 5 = 0 are held out from learning."""
    weights = train(docs, labels.where(crc_mod(F.col("doc_id"), 5) != 0))
    return (score(docs, weights).withColumn("held_out", crc_mod(F.col("doc_id"), 5) == 0)
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` not predicted toxic, with all their columns; an id goes if any row of it is toxic.

    Rows without an id are judged by their text.
    """
    weights = train(docs, labels.where(crc_mod(F.col("doc_id"), 5) != 0))
    bad = score(docs, weights).where("score >= 0.5 and doc_id is not null").select(F.col("doc_id").alias("_bad")).distinct()
    named = docs.where("doc_id is not null").join(bad, F.col("doc_id").cast("long") == F.col("_bad"), "left_anti")
    unnamed = docs.where("doc_id is null").select("text").distinct()
    held = F.xxhash64("text")  # the score's id is its text's hash here
    clean = score(unnamed.withColumn("doc_id", held), weights).where("score < 0.5").select(F.col("doc_id").alias("_clean")).distinct()
    return named.unionByName(docs.where("doc_id is null").join(clean, held == F.col("_clean"), "left_semi"))


@query()
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = learn_and_score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    worst = F.array_max(F.transform("offending", lambda s: F.struct(s["score"], -s["start"], s["start"].alias("at"))))
    return found.select("doc_id", "held_out", "score", "predicted", F.size("offending").alias("n_offending"),
                        worst["at"].alias("worst_start"))
