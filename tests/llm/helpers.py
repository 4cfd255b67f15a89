"""Small tables that every operator must take, and plain Python forms of the contracts."""

import re

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"word{i % 977} thing{i % 31}." + ("\n" if i % 12 == 0 else "") for i in range(30_000))

ODD_TEXTS = [None, "", " \n\t ", "one", "Two words", "é̂ naïve 日本語 テキスト ok 🙂 x", "a b c d e", "A B C D E", "a b c d e", LONG, "x\r\ny\x0bz\x0cw",
             "same line here\nsame line here\n\nother line", "!!! ??? ...", "a" * 5000]


def odd_docs(spark):
    """Nulls, empty and long texts, ties, a repeated row, a null id, and extra columns whose names operators use."""
    data = [(i, t, None if i % 5 == 4 else f"s{i % 3}", None, i * 7) for i, t in enumerate(ODD_TEXTS)]
    data += [data[4], (None, "no id at all", "s0", "en", 1), (None, None, None, None, None)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string, lang string, n_chars long")
    extra = ["id", "size", "start", "score", "kept", "key", "row", "part", "taken", "word", "marks", "length", "a", "b", "component"]
    return df.withColumns({c: F.lit(f"clash {c}") for c in extra}).repartition(3)


def no_docs(spark):
    return odd_docs(spark).limit(0)


def docs_of(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, f"s{i % 2}") for i, t in enumerate(texts)], "doc_id long, text string, source string")


def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(text):
    return WORD.findall(text or "")
