"""The inverted index against matching the texts themselves."""

import glob
import random
import re

from pyspark.sql import functions as F

from marketpulse.operators.keyword import match_keywords
from marketpulse.operators.keyword_index import BUCKETS, add_texts, bucket_of, read_index, search_index

WORDS = ["the", "the", "the", "bank", "of", "america", "de", "la", "License", "MIT", "été", "x1", "worthless"]
KEYWORDS = [("A", '"bank of america"'), ("B", "america bank"), ("C", '"the the"'), ("D", "the"), ("E", '"de la de"'),
            ("F", "MIT license nowhere"), ("G", '""'), ("H", None), (None, "ÉTÉ"), ("I", " x1 "), ("I", " x1 "), ("J", '"MIT License"')]


def texts(spark, n=300):
    rnd = random.Random(7)
    rows = [(i, rnd.choice([" ", "-", "  ", ". "]).join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 12))), "s") for i in range(n)]
    rows += [(n, None, "s"), (n + 1, "", "s"), (n + 2, "...", "s"), (None, "bank of america", "s"), (n + 3, ", the the", "s")]
    rows.append((n + 4, "the " * 200_000 + "bank of america", "s"))
    return spark.createDataFrame(rows, "doc_id long, text string, word string")


def brute(rows):
    out = set()
    for i, text, _ in rows:
        w = [x for x in re.split(r"[^\w]+|_", (text or "").lower()) if x]
        for key, kw in KEYWORDS:
            need = [x for x in re.split(r"[^\w]+", (kw or "").lower()) if x]
            if not need:
                continue
            if kw.strip().startswith('"'):
                hit = any(w[j:j + len(need)] == need for j in range(len(w)))
            else:
                hit = set(need) <= set(w)
            if hit:
                out.add((i, key, kw))
    return out


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_index_scan_and_brute_force_agree(spark, tmp_path_str):
    docs = texts(spark)
    kw = spark.createDataFrame(KEYWORDS, "ticker string, keyword string")
    for day in range(4):
        add_texts(docs.where(f"coalesce(doc_id, 0) % 4 = {day}"), tmp_path_str, f"d{day}")
    add_texts(docs.where("coalesce(doc_id, 0) % 4 = 1"), tmp_path_str, "d1")  # a repeated load replaces itself
    want = brute([tuple(r) for r in docs.collect()])
    assert found(match_keywords(docs, kw)) == want
    assert found(match_keywords(docs, kw.hint("shuffle_merge"))) == want
    assert found(search_index(read_index(spark, tmp_path_str), kw)) == want


def test_only_the_buckets_of_the_dictionary_are_read(spark, tmp_path_str):
    add_texts(texts(spark), tmp_path_str, "a")
    kw = spark.createDataFrame([("A", '"bank of america"')], "ticker string, keyword string")
    named = {r[0] for r in spark.createDataFrame([("bank",), ("of",), ("america",)], "w string")
             .select(bucket_of(F.col("w"), BUCKETS)).collect()}
    other = [f for f in glob.glob(f"{tmp_path_str}/load=a/bucket=*") if int(f.rsplit("=", 1)[1]) not in named]
    assert 0 < len(named) <= 3 and len(other) > 3
    index = read_index(spark, tmp_path_str)
    for folder in other:  # a file of another bucket, were it read, would fail the search
        for file in glob.glob(folder + "/*.parquet"):
            with open(file, "wb") as f:
                f.write(b"not parquet")
    want = {r for r in brute([tuple(r) for r in texts(spark).collect()]) if r[1] == "A"}
    assert found(search_index(index, kw)) == want


def test_no_texts_and_no_keywords(spark, tmp_path_str):
    add_texts(texts(spark, 5), tmp_path_str, "a")
    none = spark.createDataFrame([], "ticker string, keyword string")
    assert search_index(read_index(spark, tmp_path_str), none).count() == 0
    assert match_keywords(texts(spark, 5), none).count() == 0
    assert match_keywords(texts(spark, 5).limit(0), spark.createDataFrame(KEYWORDS, none.schema)).count() == 0
