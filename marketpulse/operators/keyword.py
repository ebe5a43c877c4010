"""Search-keyword matching of texts.

Search strings follow the search source's convention: a string in double
quotes is an exact phrase, otherwise every term must occur. Outer blanks do
not matter; matching is case-insensitive on whole words, where a word is a
run of letters and digits. A NULL or wordless keyword matches nothing, and a
repeated dictionary entry counts once.

One plan for any dictionary: keywords become rows ``(keyword, word, place)``,
texts become rows ``(text, word, position)``, and the two are joined on the
word. A phrase of n words occurs where n different places agree on the start
``position - place``; an all-terms keyword has start 0 throughout, so it
occurs when all its distinct words do. Before the join a text's words pass a fixed
map of ``FILTER_BITS`` bits, set at the hashes of the dictionary's words (a
scalar subquery), which lets through all dictionary words and few others. So what
moves and what is grouped follows the matches, not the text; nothing is
collected, and Spark broadcasts the dictionary or shuffles by its size in
bytes. Occurrences of a word are dealt over ``SPREAD`` parts, each of which gets
the word's keywords, so no task of a shuffled join sorts a frequent word whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketpulse.functions.columns import WORD_SPLIT


FILTER_BITS = 1 << 16
SPREAD = 64


def words_of(c) -> Column:
    """The words of a text in order; NULL text has none."""
    norm = F.trim(F.regexp_replace(F.lower(F.col(c) if isinstance(c, str) else c), WORD_SPLIT, " "))
    return F.filter(F.split(norm, " "), lambda w: w != "")


def keyword_words(keywords: DataFrame, key_col: str = "ticker", keyword_col: str = "keyword") -> DataFrame:
    """``key, keyword, _mp_phrase, _mp_need, _mp_place, _mp_word``, one row per needed word."""
    kw = F.trim(keyword_col)
    phrase = (F.length(kw) >= 2) & kw.startswith('"') & kw.endswith('"')
    words = F.when(phrase, words_of(kw)).otherwise(F.array_distinct(words_of(kw)))
    return (keywords.select(key_col, keyword_col).where(F.col(keyword_col).isNotNull()).distinct()
            .select(key_col, keyword_col, phrase.alias("_mp_phrase"), F.size(words).alias("_mp_need"),
                    F.posexplode(words).alias("_mp_place", "_mp_word")))


def word_filter(words: DataFrame, word_col: str = "_mp_word") -> DataFrame:
    """One row with an array of 64-bit masks: bit h is set if a word hashes to h."""
    h = F.pmod(F.xxhash64(word_col), F.lit(FILTER_BITS))
    masks = (words.select(h.alias("h")).groupBy(F.expr("h div 64").alias("at"))
             .agg(F.bit_or(F.call_function("shiftleft", F.expr("1L"), F.expr("int(h % 64)"))).alias("mask")))
    by_place = masks.agg(F.map_from_entries(F.collect_list(F.struct("at", "mask"))).alias("masks"))
    places = F.sequence(F.lit(0).cast("bigint"), F.lit(FILTER_BITS // 64 - 1).cast("bigint"))
    return by_place.select(F.transform(places, lambda i: F.coalesce(F.try_element_at("masks", i), F.expr("0L"))))


def match_keywords(texts: DataFrame, keywords: DataFrame, text_col: str = "text",
                   key_col: str = "ticker", keyword_col: str = "keyword", keep=("doc_id",)) -> DataFrame:
    """One row per (text, matching keyword): ``keep`` columns + key + keyword.

    ``keep`` must identify a text.
    """
    keep = list(keep)
    needed = keyword_words(keywords, key_col, keyword_col)
    # empty strings at a text's ends only shift all its positions by one
    words = F.split(F.lower(F.col(text_col)), WORD_SPLIT)
    h = F.pmod(F.xxhash64("_mp_word"), F.lit(FILTER_BITS))
    mask = F.get(word_filter(needed).scalar(), (F.call_function("shiftright", h, F.lit(6))).cast("int"))
    known = F.call_function("shiftright", mask, (h % 64).cast("int")).bitwiseAND(F.expr("1L")) == 1
    tokens = texts.select(*keep, F.posexplode(words).alias("_mp_pos", "_mp_word")).where(known)
    tokens = tokens.withColumn("_mp_part", F.pmod(F.xxhash64(*keep, "_mp_pos"), F.lit(SPREAD)).cast("int"))
    needed = needed.withColumn("_mp_part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    hits = tokens.join(needed, ["_mp_word", "_mp_part"])
    start = F.when(F.col("_mp_phrase"), F.col("_mp_pos") - F.col("_mp_place")).otherwise(F.lit(0))
    # NULL keys and ids group together with themselves, as the text they stand for does
    entry = [*keep, key_col, keyword_col]
    found = (hits.select(*entry, "_mp_need", start.alias("_mp_start"), "_mp_place").distinct()
             .groupBy(*entry, "_mp_need", "_mp_start").agg(F.count(F.lit(1)).alias("_mp_n"))
             .where(F.col("_mp_n") == F.col("_mp_need")))
    return found.select(*entry).distinct()
