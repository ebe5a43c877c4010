"""Positional inverted index for keyword search over stored texts.

The index is a Parquet table of postings ``(word, <text id>, pos)`` by word bucket::

    <root>/load=<id>/bucket=<hash of the word mod buckets>/part-*.parquet

Each load (a day's texts) adds a folder of its own and no texts are split again. A scan task sorts
its postings by bucket, word, text and position and writes one segment a bucket: nothing is
shuffled, so a word in every text is as many segments as there were tasks, and
sorted columns pack into a few bytes a posting.

A search reads only the buckets of the dictionary's words, once, and keeps the
postings of these words as a table. Every keyword starts from the postings of its rarest
word and is checked against its other words in order of frequency: an equi-join on
(word, text, position) for a phrase, on (word, text) for all terms. So the list of
a frequent word is only probed for the texts that are left, and its postings spread over
all tasks by text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketpulse.functions.columns import WORD_SPLIT, all_of
from marketpulse.operators.keyword import keyword_words
from marketpulse.session import scratch_path

BUCKETS = 32


def bucket_of(word: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(buckets)).cast("int")


def add_texts(texts: DataFrame, root: str, load_id: str, text_col: str = "text", keep=("doc_id",),
              buckets: int = BUCKETS) -> None:
    """Index texts as one load, or replace the load of that id. ``keep`` identifies a text; NULL text has no words.

    All loads of an index use the same ``buckets``.
    """
    words = F.split(F.lower(F.col(text_col)), WORD_SPLIT)
    postings = (texts.select(*keep, F.posexplode(words).alias("pos", "word")).where(F.col("word") != "")
                .select("word", *keep, "pos", bucket_of(F.col("word"), buckets).alias("bucket")))
    (postings.sortWithinPartitions("bucket", "word", *keep, "pos").write.mode("overwrite").partitionBy("bucket")
     .option("compression", "zstd").option("parquet.writer.version", "v2").parquet(f"{root}/load={load_id}"))


def read_index(spark: SparkSession, root: str) -> DataFrame:
    """The postings of all loads."""
    return spark.read.parquet(root)


def search_index(index: DataFrame, keywords: DataFrame, key_col: str = "ticker", keyword_col: str = "keyword",
                 keep=("doc_id",), buckets: int = BUCKETS) -> DataFrame:
    """One row per (text, matching keyword): ``keep`` columns, key and keyword, as ``match_keywords`` over the texts.

    Search strings mean the same: a phrase in double quotes, else all terms, on
    whole words without case. The driver learns which of the ``buckets`` the
    dictionary names and how many words its longest phrase and its longest list of terms have.
    """
    spark = index.sparkSession
    keep, entry = list(keep), [key_col, keyword_col]
    words = keyword_words(keywords, key_col, keyword_col).withColumn("bucket", bucket_of(F.col("_mp_word"), buckets))
    named = sorted(r[0] for r in words.select("bucket").distinct().collect())
    longest = {r[0]: r[1] for r in words.groupBy("_mp_phrase").agg(F.max("_mp_need")).collect()}
    postings = index.where(F.col("bucket").isin(named)).select(F.col("word").alias("_mp_word"), *keep, F.col("pos").alias("_mp_pos"))
    postings, folder = postings.join(words.select("_mp_word").distinct(), "_mp_word", "left_semi"), scratch_path(spark, "postings")
    postings.write.parquet(folder)
    postings = spark.read.schema(postings.schema).parquet(folder)
    often = (postings.groupBy("_mp_word").agg(F.count(F.lit(1)).alias("_mp_often")))
    # the words of a keyword by frequency; one that occurs nowhere comes first and ends the search
    rarest = Window.partitionBy(*entry).orderBy(F.coalesce("_mp_often", F.lit(0)), "_mp_place")
    words = (words.join(often, "_mp_word", "left").withColumn("_mp_turn", F.row_number().over(rarest))
             .select(*entry, "_mp_phrase", "_mp_need", "_mp_place", "_mp_word", "_mp_turn"))
    start = F.when(F.col("_mp_phrase"), F.col("_mp_pos") - F.col("_mp_place")).otherwise(F.lit(0))
    first = (postings.join(words.where("_mp_turn = 1"), "_mp_word")
             .select(*keep, *entry, "_mp_phrase", "_mp_need", start.alias("_mp_start")).distinct())
    done = first.where("_mp_need = 1").select(*keep, *entry)
    for phrase, most in longest.items():
        found = first.where(F.col("_mp_phrase") == phrase)
        for turn in range(2, most + 1):
            found = _checked(found, words.where(F.col("_mp_turn") == turn), postings, keep, entry, phrase)
            done = done.unionByName(found.where(F.col("_mp_need") == turn).select(*keep, *entry))
    return done.distinct()


def _checked(found: DataFrame, words: DataFrame, postings: DataFrame, keep: list[str], entry: list[str],
             phrase: bool) -> DataFrame:
    """The candidates at which the next word of their keyword stands too."""
    w = words.select(*[F.col(c).alias(f"_mp_w{i}") for i, c in enumerate(entry)], F.col("_mp_word").alias("_mp_next"),
                     F.col("_mp_place").alias("_mp_next_place"))
    same = all_of([F.col(c).eqNullSafe(F.col(f"_mp_w{i}")) for i, c in enumerate(entry)])
    asked = found.join(w, same).drop(*[f"_mp_w{i}" for i in range(len(entry))])
    p = postings.select("_mp_word", "_mp_pos", *[F.col(c).alias(f"_mp_k{i}") for i, c in enumerate(keep)])
    text = all_of([F.col("_mp_next") == F.col("_mp_word")] + [F.col(c).eqNullSafe(F.col(f"_mp_k{i}")) for i, c in enumerate(keep)])
    if phrase:
        text = text & (F.col("_mp_start") + F.col("_mp_next_place") == F.col("_mp_pos"))
    return asked.join(p, text).select(*keep, *entry, "_mp_phrase", "_mp_need", "_mp_start").distinct()
