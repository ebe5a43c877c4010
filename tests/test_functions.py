from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from marketpulse.functions.columns import (
    case_map, epoch_micros, floor_to, is_weekday, iso_z, parse_iso_utc, partition_date,
    without_phrase,
)
from marketpulse.operators.keyword import keyword_words, match_keywords
from marketpulse.operators.tagging import with_sector_case
from marketpulse.sources.company import COMPANIES, SECTOR_CASE_ARMS


def one(spark, col, value, ddl):
    return spark.createDataFrame([(value,)], f"v {ddl}").select(col.alias("out")).first()[0]


def test_parse_iso_utc_honours_offsets(spark):
    df = spark.createDataFrame([("2021-12-02T14:30:00.000Z",), ("2021-12-02T15:30:00.5+01:00",),
                                ("not a time",), (None,)], "s string")
    got = [r[0] for r in df.select(parse_iso_utc("s")).collect()]
    assert got == [datetime(2021, 12, 2, 14, 30), datetime(2021, 12, 2, 14, 30, 0, 500000), None, None]


def test_iso_z_like_isoformat(spark):
    df = spark.sql("select timestamp_ntz'2021-12-04 14:30:00' a, timestamp_ntz'2021-12-04 14:30:00.000120' b")
    r = df.select(iso_z("a"), iso_z("b")).first()
    assert r[0] == datetime(2021, 12, 4, 14, 30).isoformat() + "Z"
    assert r[1] == datetime(2021, 12, 4, 14, 30, 0, 120).isoformat() + "Z"


def test_partition_date_ignores_pattern_k1(spark):
    df = spark.sql("select timestamp_ntz'2021-12-04 23:59:59.9' t")
    assert df.select(partition_date("t"), F.to_date("t", "yyyyMMdd")).first() == (date(2021, 12, 4),) * 2


def test_weekday_membership(spark):
    # 2024-01-06 is a Saturday, 2024-01-07 a Sunday
    days = [date(2024, 1, d) for d in range(1, 9)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    kept = sorted(r[0].day for r in df.where(is_weekday("d")).collect())
    assert kept == [1, 2, 3, 4, 5, 8]


def test_negated_contains_case_sensitive_and_null_dropped_k4(spark):
    df = spark.createDataFrame([("at Bank of America Stadium",), ("at bank of america stadium",),
                                (None,), ("plain",)], "text string")
    kept = [r[0] for r in df.where(without_phrase("text", "Bank of America Stadium")).collect()]
    assert sorted(kept) == ["at bank of america stadium", "plain"]


def test_sector_case_quirks_k7(spark):
    df = spark.createDataFrame([("BA",), ("BA ",), ("VWDRY",), ("DVN",), ("CAT",), ("na?",), (None,)],
                               "key_flag string")
    got = dict((r[0], r[1]) for r in with_sector_case(df).collect())
    assert got["BA"] == "na" and got["BA "] == "Manufacturing"
    assert got["VWDRY"] == "na" and got["DVN"] == "na"
    assert got["CAT"] == "Manufacturing" and got["na?"] == "na" and got[None] == "na"
    assert len(SECTOR_CASE_ARMS) == 24 and len(COMPANIES) == 25


def test_case_map_first_arm_wins(spark):
    df = spark.createDataFrame([("a",)], "k string")
    assert df.select(case_map("k", [("a", "1"), ("a", "2")], "z")).first()[0] == "1"


@pytest.mark.parametrize("tz", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_epoch_micros_zone_free(spark, tz):
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        vals = [datetime(2024, 3, 10, 2, 30, 0, 250000), datetime(1969, 12, 31, 23, 59, 59, 999999),
                datetime(2021, 12, 2, 1, 30), datetime(2024, 11, 3, 1, 30, 0, 7)]
        df = spark.createDataFrame([(v.isoformat(sep=" "),) for v in vals], "s string") \
            .select(F.col("s").cast("timestamp_ntz").alias("t"))
        got = [r[0] for r in df.select(epoch_micros("t")).collect()]
        want = [(v - datetime(1970, 1, 1)) // __import__("datetime").timedelta(microseconds=1) for v in vals]
        assert got == want
        fl = df.select(floor_to("t", 3_600_000_000, 1_800_000_000)).collect()
        assert fl[0][0] == datetime(2024, 3, 10, 2, 30)
        assert fl[1][0] == datetime(1969, 12, 31, 23, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_keyword_words(spark):
    kw = spark.createDataFrame([("A", '"Bank of America"'), ("B", "deere co deere"), ("C", ' "iShares U.S. Oil" '),
                                ("D", '""'), ("E", None), ("B", "deere co deere")], "ticker string, keyword string")
    got = {}
    for r in keyword_words(kw).orderBy("_mp_place").collect():
        got.setdefault((r.ticker, r._mp_phrase, r._mp_need), []).append(r._mp_word)
    assert got == {("A", True, 3): ["bank", "of", "america"], ("B", False, 2): ["deere", "co"],
                   ("C", True, 4): ["ishares", "u", "s", "oil"]}


def test_match_keywords_phrase_vs_all_terms(spark):
    docs = spark.createDataFrame([(1, "Deere & Co. reports"), (2, "co-founded by Deere"),
                                  (3, "Bank of America, N.A."), (4, "America's bank of choice"),
                                  (5, None)], "doc_id long, text string")
    kw = spark.createDataFrame([("DE", "deere co"), ("BAC", '"Bank of America"')], "ticker string, keyword string")
    got = sorted((r.doc_id, r.ticker) for r in match_keywords(docs, kw).collect())
    assert got == [(1, "DE"), (2, "DE"), (3, "BAC")]


def test_keyword_queries_keep_the_partitions_of_the_scan(spark, capsys):
    from marketpulse import queries

    for query in (queries.q_keyword_match, queries.q_keyword_match_join, queries.q_keyword_dictionary):
        query(spark, "/root/testdata/sf0.001").explain()
        plan = capsys.readouterr().out
        assert "FileScan" in plan and "RoundRobin" not in plan and "REPARTITION_BY_NUM" not in plan


def test_keyword_odd_dictionary(spark):
    docs = spark.createDataFrame([(1, "the Bank of America bank"), (2, "bank of the America"), (3, None), (4, ""),
                                  (5, "go go go went gone"), (6, "GO, go!")], "doc_id int, text string")
    kw = spark.createDataFrame([("A", '"Bank of America"'), ("A", '"Bank of America"'), ("B", ' "bank of america" '),
                                ("C", "america bank"), ("N", None), (None, "the"), ("G", '"go go"'), ("H", '"go go go"')],
                               "ticker string, keyword string")
    got = sorted(((r.doc_id, r.ticker) for r in match_keywords(docs, kw).collect()), key=repr)
    assert got == sorted([(1, "A"), (1, "B"), (1, "C"), (2, "C"), (1, None), (2, None), (5, "G"), (6, "G"), (5, "H")], key=repr)
    assert match_keywords(docs, kw.limit(0)).count() == 0 and match_keywords(docs.limit(0), kw).count() == 0


def test_keyword_many_entries(spark):
    """No size of dictionary changes the result."""
    docs = spark.createDataFrame([(i, f"w{i} w{i + 1} tail") for i in range(50)], "doc_id int, text string")
    for n in (10, 2000):
        kw = spark.range(n).selectExpr("concat('K', id) as ticker", "concat('\"w', id, ' w', id + 1, '\"') as keyword")
        assert match_keywords(docs, kw).count() == min(n, 50)


def test_frequent_keyword_word_is_no_single_task(spark):
    """One word makes up all texts: a shuffled join spreads it over the tasks."""
    texts = spark.range(0, 4000, 1, 4).select(F.col("id").alias("doc_id"), F.repeat(F.lit("die "), 50).alias("text"))
    words = spark.createDataFrame([("DERDIE", "der die"), ("DIE", '"die"')], "ticker string, keyword string").hint("shuffle_merge")
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        found = match_keywords(texts, words)
        assert {(r.ticker, r.n) for r in found.groupBy("ticker").agg(F.count(F.lit(1)).alias("n")).collect()} == {("DIE", 4000)}
        plan = match_keywords(texts, words)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin [_mp_word" in plan and "_mp_part" in plan.split("SortMergeJoin")[1].split("\n")[0]
