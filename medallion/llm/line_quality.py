"""Quality rules: a linear-chain conditional random field labels each line content or boilerplate.

Viterbi decoding gives the likeliest sequence of labels of a document's lines; the share of characters in content
lines decides whether the document stays.  The field is trained on lines of documents with a quality label: lines
of low-quality documents, and repeats of earlier lines, are boilerplate, all others content.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.common import (CONTINUES, GOLDEN, SPACE, U, arrow_map, crc_mod, flags, gram_hashes, mix, span_hashes, spans,
                                  stored, table, text_runs)
from medallion.llm.registry import query

# Bound of the labelled sample that the field is fitted on (documents, chosen by a hash of their id).
MAX_TRAIN_DOCS = 4096
EPOCHS, RATE, DECAY = 150, 0.3, 1e-4
MIN_WORDS, WINDOW, MAX_REPEATED, MIN_CONTENT = 50, 3, 0.5, 0.5
BOILERPLATE, CONTENT = 0, 1

_SYMBOLS = flags(b"#*$%&|<>")
_BREAK = flags(b"\n")
_CLASSES = [flags(x) for x in (bytes(range(65, 91)), bytes(range(97, 123)) + bytes(range(128, 256)), bytes(range(48, 58)),
                               b"#*$%&<>~^=+_\\{}[]@", b"|", b"!?", b".,;:")]
N_FEATURES = 1 + len(_CLASSES) + 13


def _per_span(mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask)])
    return total[ends] - total[starts]


def line_features(column: pa.Array):
    """For runs of texts: counts of each text (the contract's four and its words), and its lines with a word.

    Lines come as a feature matrix, their characters, and first lines of each text.
    """
    for _, _, data, offsets in text_runs(column):
        n = len(offsets) - 1
        space = SPACE[data]
        w_start, w_end, w_cut = spans(space, offsets)
        l_start, l_end, l_cut = spans(_BREAK[data], offsets)
        points = ~CONTINUES[data]
        with np.errstate(over="ignore"):
            words = span_hashes(data, w_start, w_end)
            lines = span_hashes(data, l_start, l_end)
            grams, first = gram_hashes(words, w_cut, WINDOW)
        word_at = np.searchsorted(w_start, np.stack([l_start, l_end]))
        n_line_words = word_at[1] - word_at[0]
        real = np.flatnonzero(n_line_words > 0)
        doc_of_line = np.repeat(np.arange(n), np.diff(l_cut))[real]
        lines, l_start, l_end, word_at, n_line_words = lines[real], l_start[real], l_end[real], word_at[:, real], n_line_words[real]
        l_cut = np.searchsorted(doc_of_line, np.arange(n + 1))
        with np.errstate(over="ignore"):
            own = mix(lines ^ (doc_of_line.astype(np.uint64) * GOLDEN))
            _, earliest = np.unique(own, return_index=True)
            again = np.ones(len(own), bool)
            again[earliest] = False
            doc_of_word = np.repeat(np.arange(n), np.diff(w_cut))
            tied = mix(grams ^ (doc_of_word[first].astype(np.uint64) * GOLDEN))
            _, which, times = np.unique(tied, return_inverse=True, return_counts=True)
        repeated = np.zeros(len(words) + 1, bool)
        hit = first[times[which] > 1]
        for i in range(WINDOW):
            repeated[hit + i] = True
        repeated = repeated[:-1]
        count = lambda of, weights: np.bincount(of, weights, n).astype(np.int64)
        totals = {"n_words": np.diff(w_cut), "word_chars": _per_span(points & ~space, offsets[:-1], offsets[1:]),
                  "n_symbols": _per_span(_SYMBOLS[data], offsets[:-1], offsets[1:]),
                  "n_dup_lines": count(doc_of_line, again.astype(float)), "n_repeat_words": count(doc_of_word, repeated.astype(float))}
        chars = _per_span(points, l_start, l_end).astype(float)
        shares = [_per_span(m[data], l_start, l_end) / (l_end - l_start) for m in _CLASSES]
        total = np.concatenate([[0], np.cumsum(repeated)])
        with np.errstate(over="ignore"):
            paired = mix(words ^ (np.repeat(np.arange(len(n_line_words)), n_line_words).astype(np.uint64) * U(3) + U(1))
                         if n_line_words.sum() == len(words) else words)
        _, once = np.unique(paired, return_index=True)
        fresh = np.zeros(len(words), bool)
        fresh[once] = True
        distinct = np.concatenate([[0], np.cumsum(fresh)])
        mean = _per_span(points & ~space, l_start, l_end) / n_line_words
        size = np.maximum(np.diff(l_cut), 1)[doc_of_line]
        place = (np.arange(len(lines)) - l_cut[:-1][doc_of_line]) / size
        upper, _, _, symbol, bar, shout, _ = shares
        traits = [upper > 0.3, symbol > 0.02, bar > 0.02, bar > 0, shout > 0.02]
        matrix = np.stack([np.ones(len(lines)), *shares, *(x.astype(float) for x in traits), again.astype(float), (total[word_at[1]] - total[word_at[0]]) / n_line_words,
                           (distinct[word_at[1]] - distinct[word_at[0]]) / n_line_words, np.minimum(mean, 20) / 10,
                           np.log1p(chars) / 6, (n_line_words < 4).astype(float), (place == 0).astype(float), place], axis=1)
        yield totals, matrix, chars, l_cut, again


def _steps(cut: np.ndarray):
    """Positions of the t-th line of every text that has one, and those texts, for each t; longest texts first."""
    sizes = np.diff(cut)
    order = np.argsort(-sizes, kind="stable")
    live = len(order) - np.searchsorted(sizes[order][::-1], np.arange(1, (sizes.max() if len(sizes) else 0) + 1), "left")
    for t, n in enumerate(live):
        yield t, order[:n], cut[order[:n]] + t


def viterbi(scores: np.ndarray, moves: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Likeliest labels of each text's lines; scores: lines x labels, moves: label before x label. Ties go to content."""
    best, back = scores.copy(), np.zeros(scores.shape, np.int8)
    for t, _, at in _steps(cut):
        if t:
            ways = best[at - 1][:, :, None] + moves[None]
            back[at] = np.where(ways[:, 1] >= ways[:, 0], 1, 0)
            best[at] += ways.max(axis=1)
    labels = np.zeros(len(scores), np.int8)
    last = cut[1:][np.diff(cut) > 0] - 1
    labels[last] = best[last, 1] >= best[last, 0]
    for t, texts, at in reversed(list(_steps(cut))):
        if t:
            labels[at - 1] = back[at, labels[at]]
    return labels


def fit(matrix: np.ndarray, labels: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Weights of the features for content, then the four moves: gradient ascent on the conditional likelihood."""
    weights, pace = np.zeros(matrix.shape[1] + 4), np.full(matrix.shape[1] + 4, 1e-8)
    n = max(1, len(labels))
    # on an even scale for the ascent, and back again at the end
    mean, scale = matrix.mean(axis=0) if len(matrix) else 0, matrix.std(axis=0) if len(matrix) else np.ones(matrix.shape[1])
    scale, mean = np.where(scale > 1e-9, scale, 1.0), np.where(scale > 1e-9, mean, 0.0)
    matrix = (matrix - mean) / scale
    starts = cut[:-1][np.diff(cut) > 0]
    inner = np.ones(len(labels), bool)
    inner[starts] = False
    at = np.flatnonzero(inner)
    seen = np.bincount(labels[at - 1] * 2 + labels[at], minlength=4) if len(at) else np.zeros(4)
    steps = list(_steps(cut))
    for _ in range(EPOCHS):
        scores = np.stack([np.zeros(len(labels)), matrix @ weights[:-4]], axis=1)
        moves = weights[-4:].reshape(2, 2)
        ahead, behind = scores.copy(), np.zeros_like(scores)
        for t, _, p in steps:
            if t:
                ahead[p] += np.logaddexp(ahead[p - 1][:, :1] + moves[0], ahead[p - 1][:, 1:] + moves[1])
        for t, _, p in reversed(steps):
            if t:
                onward = (behind[p] + scores[p])[:, None, :] + moves[None]
                behind[p - 1] = np.logaddexp(onward[:, :, 0], onward[:, :, 1])
        both = ahead + behind
        whole = np.logaddexp(both[:, 0], both[:, 1])
        p_content = np.exp(both[:, 1] - whole)
        grad = np.empty_like(weights)
        grad[:-4] = matrix.T @ (labels - p_content) / n
        pairs = ahead[at - 1][:, :, None] + moves[None] + (behind[at] + scores[at])[:, None, :] - whole[at][:, None, None]
        grad[-4:] = (seen - np.exp(pairs).sum(axis=0).ravel()) / n
        grad -= DECAY * weights
        pace += grad**2
        weights += RATE * grad / np.sqrt(pace)
    weights[:-4] /= scale
    weights[0] -= (weights[:-4] * mean).sum()
    return weights


def train(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Weights from at most about ``MAX_TRAIN_DOCS`` labelled documents, hash-chosen, in one task.

    ``labels``: ``doc_id, quality``; nulls are left out, an id with several labels counts as low if one says so.
    Without labels every line is content.
    """
    marks = (labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.min(F.col("quality").cast("int")).alias("quality")))
    share = MAX_TRAIN_DOCS / max(marks.count(), MAX_TRAIN_DOCS)
    chosen = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < round(1_000_000 * share))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")  # MAX_TRAIN_DOCS rows

    def lines(batch: pa.RecordBatch) -> pa.Table:
        quality = batch.column("quality").to_numpy()
        held, truth, done = [], [], 0
        for _, matrix, _, cut, again in line_features(batch.column("text")):
            for i in range(len(cut) - 1):
                own = slice(cut[i], cut[i + 1])
                held.append(matrix[own].astype(np.float32).tobytes())
                truth.append(((quality[done + i] == 1) & ~again[own]).astype(np.int8).tobytes())
            done += len(cut) - 1
        return pa.table({"doc_id": batch.column("doc_id"), "lines": pa.array(held, pa.binary()), "truth": pa.array(truth, pa.binary())})

    def learn(batches):
        rows = sorted(r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("doc_id", "lines", "truth")), strict=True))
        matrix = np.concatenate([np.zeros((0, N_FEATURES), np.float32), *(np.frombuffer(r[1], np.float32).reshape(-1, N_FEATURES) for r in rows)])
        truth = np.concatenate([np.zeros(0, np.int8), *(np.frombuffer(r[2], np.int8) for r in rows)]).astype(np.int64)
        found = fit(matrix.astype(float), truth, np.cumsum([0, *(len(r[2]) for r in rows)]))
        yield pa.record_batch({"weights": pa.array([found.tobytes()], pa.binary())})

    held = arrow_map(texts, lines, "doc_id long, lines binary, truth binary")
    # scan and features are work of all tasks; one task learns from the bounded sample that they have written
    rows = stored(held).coalesce(1).mapInArrow(learn, "weights binary").collect()
    return np.frombuffer(rows[0][0]) if rows else np.zeros(N_FEATURES + 4)


def judge(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``n_lines``, ``n_content_lines``, ``content_share``, ``kept``.

    For every row of ``docs`` (``doc_id``, ``text``).  Null, empty and blank texts have no lines, a share of 0 and
    fail the base rule.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def label(batch: pa.RecordBatch) -> pa.Table:
        w, parts = shared.value, []
        for totals, matrix, chars, cut, _ in line_features(batch.column("text")):
            labels = viterbi(np.stack([np.zeros(len(matrix)), matrix @ w[:-4]], axis=1), w[-4:].reshape(2, 2), cut)
            of = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
            n = len(cut) - 1
            content = np.bincount(of, chars * labels, n) / np.maximum(np.bincount(of, chars, n), 1)
            parts.append({**totals, "n_lines": np.diff(cut), "n_content_lines": np.bincount(of, labels, n).astype(np.int64), "content_share": content})
        found = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
        return pa.table({"doc_id": batch.column("doc_id"), **found})

    found = arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), label,
                      "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                      "n_lines long, n_content_lines long, content_share double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 100 * MAX_REPEATED * F.col("n_words"))
    return found.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("content_share") >= MIN_CONTENT))


@query()
def op1_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(crc_mod(F.col("doc_id"), 5) != 0)  # the rest measures it
    return judge(docs, train(docs, labels))
