from collections import Counter

import __spark_entry__ as registered
import corpus_pipeline
from medallion.llm import hamming_dedup, mixing, secrets, toxicity
from medallion.llm.common import table
from tests.llm.helpers import SF, odd_docs, words
from tests.llm.test_dedup_mix_pack import brute_groups, check_packing


def test_the_stages_do_their_work(spark, folder):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "secret_scan", "mixing", "packing"]
    docs = table(spark, SF, "documents")
    held = [docs]
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, held[-1], SF).write.parquet(f"{folder}/{n}")
        held.append(spark.read.parquet(f"{folder}/{n}"))
        assert name == "packing" or held[-1].columns == docs.columns
    rows = [h.collect() for h in held]
    bad = {r["doc_id"] for r in toxicity.learn_and_score(docs, table(spark, SF, "labels")).where("predicted = 1").collect()}
    assert Counter(rows[1]) == Counter(r for r in rows[0] if r["doc_id"] not in bad)
    groups = brute_groups([(r["doc_id"], r["text"]) for r in rows[1]])
    assert Counter(rows[2]) == Counter(r for r in rows[1] if groups[r["doc_id"]][1] == r["doc_id"])
    found = [(r["doc_id"], r["value"]) for r in secrets.scan(held[2], path="source").where("is_secret").collect()]
    assert {r["doc_id"] for r in rows[3]} == {r["doc_id"] for r in rows[2]}
    texts = {r["doc_id"]: r for r in rows[3]}
    assert not [1 for d, v in found if v in texts[d]["text"]] and all(r["n_chars"] == len(r["text"]) for r in rows[3])
    assert {d for d, r in texts.items() if secrets.MASK in r["text"]} == {d for d, _ in found}
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(held[3]).collect()}
    mixed = Counter()
    for r in rows[4]:
        mixed[r["doc_id"]] += len(words(r["text"]))
    assert mixed == Counter({d: n for d, n in taken.items() if n})
    used, least = check_packing(rows[5], [(r["doc_id"], r["text"]) for r in rows[4]])
    assert used <= least + 1

    whole = registered.queries()["pipeline"](spark, SF)
    columns = ["doc_id", "piece", "length", "ids_crc32"]
    assert Counter(whole.select(columns).collect()) == Counter(held[5].select(columns).collect())


def test_stages_on_odd_rows_and_none(spark, folder):
    for kind in ("odd", "none"):
        docs = odd_docs(spark) if kind == "odd" else odd_docs(spark).limit(0)
        for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, SF).write.parquet(f"{folder}/{kind}{n}")
            docs = spark.read.parquet(f"{folder}/{kind}{n}")
        assert (docs.count() > 0) == (kind == "odd")


def test_every_operator_has_a_query(spark):
    names = registered.queries()
    for n in range(1, 14):
        assert len([k for k in names if k.startswith(f"op{n}_")]) == 1
    assert hamming_dedup.op3_minhash_near_dedup.__name__ in names and "op10_mix_sources" in registered.oracle_sql()
