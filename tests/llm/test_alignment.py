import hashlib
from bisect import bisect_left
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from hypothesis import given as drawn
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from medallion.llm import alignment
from tests.llm.helpers import ODD_TEXTS, SF, docs_of, given, no_docs, odd_docs

SPACED = ["a  b", " lead", "trail ", "  ", " ", "a \n b", "tab\t x", "a　b c", "x ▁ y", "▁", "<|endoftext|> a<|endoftext|>b",
          "<s> </s> <unk> <0x41>", "it's 'll don't  's", "é ﬁ Ａ", "x  y", "a\x00 b", "​x ​", "🙂 🙂🙂 日本 語", "\x1c a", "a\r\n b",
          "y" * 3000, "1 22 333 4444 55555"]


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(public_tokenizers.path(alignment.TOKENIZER_A))
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=public_tokenizers.path(alignment.TOKENIZER_B)), alignment.aligner(alignment.TOKENIZER_A, alignment.TOKENIZER_B)


def brute(tools, text):
    """Groups of a whole text, by sets of end offsets."""
    a, b, own = tools
    if not text:
        return [], [], []
    a, b, whole = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text), (" " + text).encode()
    parts = [[own.a_bytes[i] for i in a], [own.b_bytes[i] for i in b]]
    if any(b"".join(p) != whole for p in parts):
        return [], [], []
    ends = []
    for p in parts:
        at, held = 0, []
        for x in p:
            at += len(x)
            held.append(at)
        ends.append(held)
    common = sorted(set(ends[0]) & set(ends[1]))
    groups = [([], []) for _ in common]
    for side, ids in enumerate((a, b)):
        for t, end in zip(ids, ends[side]):
            groups[bisect_left(common, end)][side].append(t)
    return a, b, groups


def expected(tools, rows):
    counts, found = Counter(), []
    for doc_id, text in rows:
        a, b, groups = brute(tools, text)
        counts.update((x[-1], y[-1]) for x, y in groups)
        found.append((doc_id, a, b, groups))
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    out = Counter()
    for doc_id, a, b, groups in found:
        links = [(x[-1], y[-1]) for x, y in groups]
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out[doc_id, len(a), len(b), len(groups), len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links),
            hashlib.sha256(shown.encode()).hexdigest() if shown else ""] += 1
    return out, {(*p, n, n == most[p[1]]) for p, n in counts.items()}


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def same(tools, docs):
    found, pairs = alignment.aligned(docs)
    want, counts = expected(tools, [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert Counter(tuple(r) for r in found.select(COLUMNS).collect()) == want
    assert {tuple(r) for r in pairs.select("a", "b", "count", "best").collect()} == counts
    return want


def test_measures_and_pairs_of_given_documents(spark, tools):
    want = same(tools, given(spark))
    assert sum(want.values()) == 200 and any(k[3] < k[1] for k in want)
    rows = alignment.op11_alignment(spark, SF).select(COLUMNS).collect()
    assert Counter(tuple(r) for r in rows) == want


def test_small_blocks_give_the_same(spark, tools, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_CHUNKS", 50)
    monkeypatch.setattr(alignment, "RUN_BYTES", 300)
    docs = given(spark).limit(40)
    texts = docs.where("text <> ''").groupBy("text").agg(F.count("*").alias("copies")).withColumn("digest", F.sha2("text", 256))
    assert alignment.blocks(texts).select("block").distinct().count() >= 10
    same(tools, docs)


def test_odd_texts_copies_and_clashing_columns(spark, tools):
    want = same(tools, odd_docs(spark))
    assert want[None, 0, 0, 0, 0, 0, 0, ""] == 1 and sum(want.values()) == len(ODD_TEXTS) + 3
    docs = docs_of(spark, SPACED + SPACED[:7] * 3).withColumns({c: F.lit("x") for c in ("digest", "copies", "block", "kind", "at", "a", "count", "_block", "_most")})
    assert {k[0]: k[1] for k in same(tools, docs)}[SPACED.index("▁")] == 0
    assert alignment.aligned(no_docs(spark))[0].collect() == []
    assert alignment.op11_alignment(spark, SF).columns[0] == "doc_id"


@settings(max_examples=300, deadline=None)
@drawn(st.text(st.sampled_from("ab' \n\t　 é語1.▁s"), min_size=1, max_size=12))
def test_chunks_are_tokenised_as_in_the_whole_text(tools, text):
    own, parts = tools[2], alignment.chunks(text)
    a, b, _ = brute(tools, text)
    found = own.tokens(parts)
    assert " ".join(parts) == text
    if all(x or not p for p, (x, _) in zip(parts, found)):
        assert [t for x, _ in found for t in x] == a and [t for _, y in found for t in y] == b
