import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from medallion.llm import hamming_dedup, mixing, packing
from medallion.llm.components import components
from medallion.llm.tokens import TOKENIZER, WordIds
from tests.llm.helpers import LOWER, ODD_TEXTS, SF, docs_of, given, no_docs, odd_docs, words


def brute_groups(docs):
    sets = {}
    for d, text in docs:
        w = words((text or "").translate(LOWER))
        sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    where = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            where[g].append(d)
    shared = Counter((a, b) for ds in where.values() for i, b in enumerate(ds) for a in ds[:i])
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


def check_groups(spark, texts):
    docs = docs_of(spark, texts)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in hamming_dedup.near_duplicates(docs).collect()}
    assert found == brute_groups(list(enumerate(texts)))
    return found


def test_near_duplicates_of_the_given_documents(spark):
    docs = given(spark)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in hamming_dedup.near_duplicates(docs).collect()}
    assert found == brute_groups([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_groups_around_the_threshold(spark, monkeypatch):
    """Chains of edits, whose members are linked to neighbours only, beside many that share a passage; small blocks."""
    monkeypatch.setattr(hamming_dedup, "BLOCK", 8)
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = ["", None, "one two", "One TWO", "x"]
    for _ in range(8):
        text = rng.choices(vocabulary, k=rng.randrange(20, 90))
        for _ in range(12):
            texts.append(" ".join(text))
            for _ in range(rng.randrange(1, 4)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
    passage = rng.choices(vocabulary, k=60)
    texts += [" ".join(rng.choices(vocabulary, k=rng.randrange(5, 60)) + passage) for _ in range(40)]
    rng.shuffle(texts)
    found = check_groups(spark, texts)
    assert len({c for _, c in found.values()}) < len(texts)


def test_all_near_signatures_share_a_key():
    """The pigeonhole: signatures that differ in MAX_DISTANCE symbols have a key in common, wherever they differ."""
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**16, (500, hamming_dedup.SYMBOLS)).astype(np.uint16)
    b = a.copy()
    for row in b:
        row[rng.choice(hamming_dedup.SYMBOLS, hamming_dedup.MAX_DISTANCE, replace=False)] ^= 1
    with np.errstate(over="ignore"):
        x, y = hamming_dedup.chunk_keys(a), hamming_dedup.chunk_keys(b)
    assert all(set(i) & set(j) for i, j in zip(x, y, strict=True))


def test_pairs_with_hubs_are_met_by_key(spark):
    """Sizes and signatures go with a key's rows: its pairs are those near enough, with no pair looked up alone."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**16, hamming_dedup.SYMBOLS).astype(np.uint16)
    looks = []
    for i in range(60):
        sign = base.copy()
        sign[rng.choice(hamming_dedup.SYMBOLS, rng.integers(0, 30), replace=False)] ^= 1
        looks.append((i, int(rng.integers(70, 110)), sign))
    looks.append((7, 300, base))  # an id with two sets
    stands = spark.createDataFrame([(i, n, s.tobytes()) for i, n, s in looks], "id long, n_shingles long, signature binary")
    members = [(k, i) for k in range(3) for i in range(60) if (i + k) % 3]
    hubs = [(k, h) for k in range(3) for h in (k + 1, 7)]
    found = hamming_dedup._against_hubs(spark.createDataFrame(members, "key long, id long"),
                                        spark.createDataFrame(hubs, "key long, hub long"), stands, "id != hub")
    of = defaultdict(list)
    for i, n, s in looks:
        of[i].append((n, s))
    want = {(min(i, h), max(i, h)) for k, i in members for kk, h in hubs if k == kk and i != h
            for n, s in of[i] for nh, sh in of[h]
            if 100 * min(n, nh) >= 75 * max(n, nh) and (s != sh).sum() <= hamming_dedup.FAR}
    got = [tuple(r) for r in found.collect()]
    assert sorted(got) == sorted(want) and len(set(got)) == len(got) and want


def test_near_duplicates_of_odd_and_no_rows(spark):
    rows = hamming_dedup.near_duplicates(odd_docs(spark)).collect()
    assert len(rows) == len(ODD_TEXTS) + 3
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by[6]["component_id"] == by[7]["component_id"] == by[8]["component_id"] == 6
    assert [by[i]["n_shingles"] for i in range(5)] == [0, 0, 0, 1, 1]
    assert all(by[i]["kept"] for i in (0, 1, 2)) and not by[8]["kept"]
    assert sum(r["doc_id"] is None and r["kept"] for r in rows) == 2
    assert hamming_dedup.near_duplicates(no_docs(spark)).collect() == []
    kept = hamming_dedup.keep_one(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns and kept.count() == len(ODD_TEXTS) + 1


def test_components(spark):
    links = [(1, 2), (2, 3), (10, 11), (5, 4), (4, 5), (7, 7)] + [(i, i + 1) for i in range(100, 140)]
    found = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert {k: v for k, v in found.items() if k < 100} == {1: 1, 2: 1, 3: 1, 10: 10, 11: 10, 4: 4, 5: 4}
    assert {found[i] for i in range(100, 141)} == {100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_ids_are_the_tokenizers():
    whole, ids = Tokenizer.from_file(public_tokenizers.path(TOKENIZER)), WordIds()
    odd = [t or "" for t in ODD_TEXTS] + ["İstanbul ΣΑΣ café ﬁne", "a<|endoftext|>b", "x\x1cy", "it's IT'S 'll. \"q\" (x)-", "½ Ⅷ a1b2", "a b　c\x85d"]
    for text in odd + [r[0] for r in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet'").fetchall()]:
        assert np.frombuffer(ids.encode(text), ids.dtype).tolist() == whole.encode(text, add_special_tokens=False).ids


def check_packing(rows, docs):
    whole = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    expected = Counter()
    for d, text in docs:
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for n, at in enumerate(range(0, len(ids), 2048)):
            expected[d, n, at, len(ids[at:at + 2048]), zlib.crc32(ids[at:at + 2048].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    return len(held), -(-sum(r["length"] for r in rows) // 2048)


def test_packing(spark):
    docs = given(spark)
    used, least = check_packing(packing.packed(docs).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert used <= least + 1
    odd = odd_docs(spark)
    check_packing(packing.packed(odd).collect(), [(r["doc_id"], r["text"]) for r in odd.collect()])
    assert packing.packed(no_docs(spark)).count() == 0


def best_fit_decreasing(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= length]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - length)
        else:
            rooms.append(capacity - length)
    return len(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_the_plan_packs_as_one_by_one_best_fit_does(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([rng.randrange(1, 101), rng.randrange(20, 60), 7]) for _ in range(400)]
    moves = packing.plan(Counter(lengths), 100)
    bins, placed = defaultdict(list), Counter()
    for length, rank, n, each, first, offset in moves.tolist():
        assert rank == placed[length]
        placed[length] += n
        for i in range(n):
            bins[first + i // each].append((offset + i % each * length, length))
    assert placed == Counter(lengths)
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 100
    assert len(bins) == best_fit_decreasing(lengths, 100)
    assert len(packing.plan({}, 100)) == 0


def shares(sizes):
    """Targets by resharing the excess until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, total, target = set(names), 1.5 * sum(sizes.values()), {}
    while left:
        level = (total - sum(target.values())) / sum(weight[s] for s in left)
        above = {s for s in left if level * weight[s] > 2 * sizes[s]}
        target |= {s: 2.0 * sizes[s] for s in above} if above else {s: level * weight[s] for s in left}
        left = left - above if above else set()
    return target


@pytest.mark.parametrize("make", [given, odd_docs])
def test_mixing(spark, make):
    docs = make(spark)
    rows = mixing.mix(docs).collect()
    sizes, taken = Counter(), Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    for d in docs.select("source").distinct().collect():
        sizes[d[0]] += 0
    target = shares(sizes)
    for r in rows:
        assert r["target"] == pytest.approx(target[r["source"]]) and r["source_size"] == sizes[r["source"]]
    assert all(taken[s] == pytest.approx(target[s], abs=1) for s in target)
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((r["doc_id"], len(words(r["text"]))) for r in docs.collect())
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == docs.columns
    assert sum(len(words(r["text"])) for r in mixed.collect()) == sum(taken.values())
    whole = {r["text"] for r in docs.collect()}
    assert sum(r["text"] not in whole for r in mixed.collect()) <= len(sizes)


def test_mixing_agrees_with_sql_and_itself(spark):
    def found(columns, rows):
        return sorted(tuple(r[columns.index(c)] for c in ("doc_id", "size", "source_size", "target", "taken")) for r in rows)

    first = mixing.op10_mix_sources(spark, SF)
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    twin = duckdb.sql(mixing.ORACLE)
    assert found(first.columns, first.collect()) == found(twin.columns, twin.fetchall())
    other = mixing.mix(given(spark).repartition(7)).select("doc_id", "taken")
    assert sorted(other.collect()) == sorted(first.select("doc_id", "taken").collect())
    assert mixing.mix(no_docs(spark)).count() == 0 and mixing.mixed_rows(no_docs(spark)).count() == 0
