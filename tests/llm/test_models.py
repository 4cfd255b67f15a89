import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from medallion.llm import gru, language_model, line_quality, toxicity
from tests.llm.helpers import LOWER, ODD_TEXTS, SF, docs_of, given, no_docs, odd_docs, words


def held(doc_id, n, k=0):
    return zlib.crc32(str(doc_id).encode()) % n == k


# --- toxicity ----------------------------------------------------------------

def test_the_noisy_or_gradient_lowers_the_likelihood_of_blameless_sentences():
    """Documents carry labels, sentences do not; the sentence with the telling word takes the blame."""
    rng = np.random.default_rng(0)
    bags, labels = [], []
    for i in range(400):
        sentences = [rng.integers(0, 50, toxicity.FEATURES * 3) for _ in range(4)]
        if i % 3 == 0:
            sentences[rng.integers(4)][0] = 77
        bags.append((np.concatenate(sentences).astype(np.int32), np.full(4, 3, np.int32)))
        labels.append(int(i % 3 == 0))
    weights = toxicity.fit(np.array(labels), bags)
    assert weights[77] > 1 and weights[77] > 3 * weights[:50].max()


def test_toxicity_of_given_documents(spark):
    rows = toxicity.op8_toxicity(spark, "/root/testdata/sf0.01").collect()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert len(rows) == 1000 and all(r["held_out"] == held(r["doc_id"], 5) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    test = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(p == t for p, t in test) >= 0.88 * len(test)
    assert not [1 for p, t in test if p and not t] or sum(p and not t for p, t in test) <= 3


def test_offending_sentences_are_located(spark):
    clean = ["a quiet line about rice. another one on tea! more on bread", "rice and tea. bread? milk and honey"]
    docs = docs_of(spark, [clean[i % 2] if i % 3 else clean[i % 2] + ". You IDIOT fool now. end of it" for i in range(240)])
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    found = {r["doc_id"]: r for r in toxicity.learn_and_score(docs, labels).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for d, r in found.items():
        assert r["predicted"] == int(d % 3 == 0)
        spans = [texts[d][s["start"]:s["end"]] for s in r["offending"]]
        assert ("IDIOT" in " ".join(spans)) == (d % 3 == 0)
    assert toxicity.drop_toxic(docs, labels).count() == 160


def test_toxic_rows_without_an_id_go(spark):
    clean = ["a quiet line about rice. another one on tea! more on bread", "rice and tea. bread? milk and honey"]
    docs = docs_of(spark, [clean[i % 2] if i % 3 else clean[i % 2] + ". You IDIOT fool now. end of it" for i in range(240)])
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    unnamed = docs.where("doc_id < 6").withColumn("doc_id", F.lit(None).cast("long"))
    found = toxicity.drop_toxic(docs.unionByName(unnamed).unionByName(unnamed.withColumn("text", F.lit(None).cast("string"))), labels)
    assert found.where("doc_id is null and text is not null").count() == 4 and found.where("doc_id is not null").count() == 160
    assert found.where("text like '%IDIOT%'").count() == 0


def test_toxicity_of_odd_rows_and_without_labels(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(0, 1), (3, None), (None, 1), (4, 0), (4, 1)], "doc_id long, toxic int")
    for marks in (labels, labels.limit(0)):
        rows = toxicity.learn_and_score(docs, marks).collect()
        assert len(rows) == len(ODD_TEXTS) + 3 and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.drop_toxic(docs, labels.limit(0)).count() == len(ODD_TEXTS) + 3
    assert toxicity.learn_and_score(no_docs(spark), labels).count() == 0


# --- line quality --------------------------------------------------------------

def base(text):
    text = text or ""
    w, seen, dup = words(text), set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
        seen.add(line)
    runs = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    again = {j for i in range(len(w) - 2) if runs[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(again),
            len(w) < 50 or 100 * len(again) > 50 * len(w))


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_counts(spark):
    none = np.zeros(line_quality.N_FEATURES + 4)
    for docs in (given(spark), odd_docs(spark)):
        found = Counter((r["doc_id"], *(r[c] for c in BASE)) for r in line_quality.judge(docs, none).collect())
        assert found == Counter((r["doc_id"], *base(r["text"])) for r in docs.collect())
    assert line_quality.judge(no_docs(spark), none).count() == 0


def test_quality_of_held_out_documents(spark):
    rows = line_quality.op1_line_quality(spark, "/root/testdata/sf0.1").collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    test = [(bool(r["kept"]), labels[r["doc_id"]]) for r in rows if held(r["doc_id"], 5) and r["doc_id"] in labels and not r["base_failed"]]
    assert sum(k == q for k, q in test) >= 0.98 * len(test) and {q for _, q in test} == {0, 1}
    assert not any(r["kept"] and r["base_failed"] for r in rows)


def test_training_without_labels_and_on_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(9, 1), (11, 0), (3, None), (None, 1), (4, 0), (4, 1), (0, 1)], "doc_id long, quality int")
    assert np.isfinite(line_quality.train(docs, labels)).all()
    assert line_quality.judge(docs, line_quality.train(docs, labels.limit(0))).count() == len(ODD_TEXTS) + 3


def test_viterbi_against_all_sequences():
    rng = np.random.default_rng(2)
    cut = np.array([0, 3, 3, 4, 9])
    scores, moves = rng.normal(size=(9, 2)), rng.normal(size=(2, 2))
    found = line_quality.viterbi(scores, moves, cut)
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        if b > a:
            def total(way, a=a):
                return sum(scores[a + i, y] for i, y in enumerate(way)) + sum(moves[x, y] for x, y in zip(way, way[1:]))
            ways = [[k >> i & 1 for i in range(b - a)] for k in range(1 << (b - a))]
            assert found[a:b].tolist() == max(ways, key=total)


def test_crf_training_learns_the_labels():
    rng = np.random.default_rng(3)
    matrix = np.concatenate([np.ones((600, 1)), rng.normal(size=(600, line_quality.N_FEATURES - 1))], axis=1)
    labels = (matrix[:, 1] > 0.2).astype(np.int64)
    cut = np.arange(0, 601, 6)
    w = line_quality.fit(matrix, labels, cut)
    scores = np.stack([np.zeros(600), matrix @ w[:-4]], axis=1)
    assert (line_quality.viterbi(scores, w[-4:].reshape(2, 2), cut) == labels).mean() > 0.95


# --- language model --------------------------------------------------------------

def toy(seed=0):
    rng = np.random.default_rng(seed)
    p = gru.initial(rng.integers(1, 50, gru.HEAD).astype(float), rng.integers(1, 50, gru.TAILS).astype(float))
    return rng, {k: v.astype(np.float32) for k, v in p.items()}


def test_gradients_against_differences(monkeypatch):
    monkeypatch.setattr(gru, "F4", np.float64)
    rng, p = toy()
    p = {k: v.astype(np.float64) + 0.05 * rng.normal(size=v.shape) for k, v in p.items()}
    symbols, fresh = rng.integers(0, gru.SYMBOLS, (5, 3)), np.zeros((5, 3), bool)
    fresh[0], fresh[3, 1] = True, True
    targets = rng.integers(0, gru.SYMBOLS, (5, 3))
    start = np.zeros((3, gru.HIDDEN))

    def loss(q):
        states, _, _ = gru.forward(q, symbols, fresh, start)
        return -gru.log_probs(q, states.astype(float).reshape(-1, gru.HIDDEN), targets.ravel())[0].mean()

    grads = {k: np.zeros_like(v) for k, v in p.items()}
    states, _, tape = gru.forward(p, symbols, fresh, start, keep=True)
    _, dh = gru.log_probs(p, states.reshape(-1, gru.HIDDEN), targets.ravel(), grads)
    gru.backward(p, symbols, fresh, tape, dh.reshape(states.shape), grads)
    for name in p:
        for at in np.argsort(-np.abs(grads[name]).ravel())[:3]:
            step = np.zeros(p[name].size)
            step[at] = 1e-4
            step = step.reshape(p[name].shape)
            slope = (loss(p | {name: p[name] + step}) - loss(p | {name: p[name] - step})) / 2e-4
            assert grads[name].ravel()[at] == pytest.approx(slope, rel=0.03, abs=1e-6), name


def test_probabilities_sum_to_one_and_lanes_do_not_matter():
    rng, p = toy(1)
    h = rng.normal(size=(1, gru.HIDDEN)).astype(np.float32)
    every = np.arange(gru.SYMBOLS)
    assert np.exp(gru.log_probs(p, np.repeat(h, gru.SYMBOLS, 0), every)[0].astype(float)).sum() == pytest.approx(1, abs=1e-4)
    sizes = rng.integers(1, 90, 40)
    symbols = rng.integers(1, gru.SYMBOLS, int((sizes - 1).sum()))
    one = gru.score(p, symbols, sizes, n_lanes=1, window=10_000)
    for lanes, window in ((7, 5), (256, 64)):
        assert gru.score(p, symbols, sizes, lanes, window) == pytest.approx(one, rel=1e-4)


def test_one_long_text_beside_short_ones_is_laid_out_window_by_window():
    """The layout as one array of steps by lanes would take 40,000 x 256 x 8 bytes, 82 MB."""
    _, p = toy(3)
    sizes = np.concatenate([[40_000], np.full(255, 2)])
    symbols = np.random.default_rng(5).integers(1, gru.SYMBOLS, int((sizes - 1).sum()))
    tracemalloc.start()
    found = gru.score(p, symbols, sizes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6
    assert found[:1] == pytest.approx(gru.score(p, symbols[:39_999], sizes[:1]), rel=1e-4)


def test_training_learns_an_order_of_words():
    _, p = toy(2)
    symbols, sizes = np.tile(np.arange(1, 9), 400), np.full(400, 9)
    better = gru.train(p, symbols, sizes, n_lanes=8, rate=0.02)
    assert gru.score(better, symbols, sizes).mean() > gru.score(p, symbols, sizes).mean() + 5


def test_every_training_document_moves_the_weights(spark):
    text = "one two three four one two three four " * 20
    hashes, tails, _ = next(language_model.hashed_words(pa.array([text])))
    seen, at, n = np.unique(hashes, return_index=True, return_counts=True)
    lexicon, (_, p) = language_model.Lexicon(seen, tails[at], n), toy(4)
    for doc_id in range(6):
        got = language_model.learn(docs_of(spark, [text], first=doc_id), lexicon, p, 161)
        assert any((got[k] != p[k]).any() for k in p), doc_id


def test_base_scores(spark):
    for docs, better in ((spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), True), (odd_docs(spark), False)):
        rows = language_model.score_documents(docs).collect()
        texts = [(r["doc_id"], words((r["text"] or "").translate(LOWER)) + [None]) for r in docs.collect()]
        counts = Counter(w for d, ws in texts if d is None or not held(d, 7, 2) for w in ws)
        total, distinct = sum(counts.values()), len(counts)
        logs = {w: math.log10((n + 1) / (total + distinct + 1)) for w, n in counts.items()}
        zero = math.log10(1 / (total + distinct + 1))
        expected = sorted((str(d), len(ws), sum(w in counts for w in ws), round(sum(logs.get(w, zero) for w in ws), 4)) for d, ws in texts)
        assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 4)) for r in rows) == expected
        assert all(r["train_tokens"] == total and r["held_out"] == (r["doc_id"] is not None and held(r["doc_id"], 7, 2)) for r in rows)
        assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
        if better:
            out = [r for r in rows if r["held_out"]]
            assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_words_that_share_a_slot_are_counted_all(spark, monkeypatch):
    """With a table of few slots and few frequent words most counts come through the join; nothing changes."""
    docs = given(spark)
    first = {r["doc_id"]: (r["n_known"], round(r["base_score"], 6)) for r in language_model.score_documents(docs).collect()}
    monkeypatch.setattr(language_model, "FREQUENT", 2000)
    monkeypatch.setattr(language_model, "SLOT_BITS", 8)
    second = {r["doc_id"]: (r["n_known"], round(r["base_score"], 6)) for r in language_model.score_documents(docs).collect()}
    assert first == second


def test_language_model_without_rows(spark):
    assert language_model.score_documents(no_docs(spark)).count() == 0
    only_held = docs_of(spark, ["a b"], first=next(i for i in range(99) if held(i, 7, 2)))
    row = language_model.score_documents(only_held).first()
    assert (row["train_tokens"], row["n_known"], row["n_tokens"], row["base_score"]) == (0, 0, 3, 0.0) and math.isfinite(row["score"])
    assert SF


def test_documents_are_learned_in_the_order_of_their_content():
    draw = np.random.default_rng(2)
    docs = [draw.integers(0, 300, n) for n in (0, 5, 3, 0, 9, 1, 5)]
    flat = lambda held: (np.concatenate(held), np.array([len(d) + 1 for d in held]))
    symbols, sizes = language_model.in_order(*flat(docs))
    again = language_model.in_order(*flat([docs[i] for i in draw.permutation(len(docs))]))
    assert np.array_equal(symbols, again[0]) and np.array_equal(sizes, again[1])
    assert Counter(tuple(x) for x in np.split(symbols, np.cumsum(sizes - 1)[:-1])) == Counter(map(tuple, docs))
