from datetime import date, datetime

from pyspark.sql import functions as F

from marketpulse.operators.timegrid import HourGrid
from marketpulse.plans.bronze import bronze_frame, bulk_load, incremental_load, read_bronze
from marketpulse.plans.gold import build_gold, correction_rows
from marketpulse.plans.silver import build_silver
from marketpulse.sources.company import company_dim

POSTS = "user string, created_at timestamp_ntz, id string, text string, ticker string"


def posts(spark, rows):
    return spark.createDataFrame(
        [(u, None if t is None else t.isoformat(sep=" "), i, x, k) for u, t, i, x, k in rows],
        "user string, t string, id string, text string, ticker string"
    ).select("user", F.col("t").cast("timestamp_ntz").alias("created_at"), "id", "text", "ticker")


def test_bronze_frame_tags_filters_and_keeps_id(spark):
    dim = company_dim(spark)
    p = posts(spark, [("u1", datetime(2021, 12, 4, 10), "1", "hello", "BAC"),          # Saturday
                      ("u2", datetime(2021, 12, 6, 10), "2", "at Bank of America Stadium", "BAC"),
                      ("u3", datetime(2021, 12, 6, 11), "3", None, "CAT"),             # NULL text dropped
                      ("u4", datetime(2021, 12, 6, 12), "4", "x", "NOPE")])            # unknown key
    rows = bronze_frame(p, dim, "2021-12-07").collect()
    assert [(r.id, r.Ticker, r.company, r.CompanySector, r.load_date, r.Tweet_date) for r in rows] == \
        [("1", "BAC", '"Bank of America"', "Banks", date(2021, 12, 7), date(2021, 12, 4))]
    assert bronze_frame(p, dim, "2021-12-07", weekday_only=True).count() == 0  # K8
    assert bronze_frame(p, dim, blank_id=True).first().id is None              # K5 option


def test_bulk_then_incremental_hwm_k10(spark, tmp_path_str):
    dim = company_dim(spark)
    path = tmp_path_str + "/bronze"
    first = [("u", datetime(2021, 12, 6, h), str(h), "t", "CAT") for h in range(8, 12)]
    later = [("u", datetime(2021, 12, 7, 9), "20", "t", "CAT"),
             ("u", datetime(2021, 12, 11, 9), "21", "t", "CAT")]           # Saturday: dropped
    bulk_load(posts(spark, first), dim, path, "2021-12-06")
    incremental_load(posts(spark, first + later), dim, path, "2021-12-07")
    ids = sorted(r.id for r in read_bronze(spark, path).collect())
    assert ids == ["10", "11", "11", "20", "8", "9"]  # the post on the mark is appended again
    path2 = tmp_path_str + "/bronze2"
    bulk_load(posts(spark, first), dim, path2, "2021-12-06")
    incremental_load(posts(spark, first + later), dim, path2, "2021-12-07", dedupe=True)
    assert sorted(r.id for r in read_bronze(spark, path2).collect()) == ["10", "11", "20", "8", "9"]


def test_incremental_per_ticker_k9(spark, tmp_path_str):
    dim = company_dim(spark)
    path = tmp_path_str + "/bronze"
    bulk_load(posts(spark, [("u", datetime(2021, 12, 6, 8), "1", "t", "BAC"),
                            ("u", datetime(2021, 12, 6, 20), "2", "t", "CAT")]), dim, path)
    late_bac = ("u", datetime(2021, 12, 6, 12), "3", "t", "BAC")  # after BAC's mark, before the global one
    incremental_load(posts(spark, [late_bac]), dim, path, per_ticker=True)
    assert "3" in [r.id for r in read_bronze(spark, path).collect()]


def test_incremental_loads_from_an_unmoved_mark_are_kept(spark, tmp_path_str):
    dim = company_dim(spark)
    day = lambda h: datetime(2021, 12, 6, h)
    first = [("u", day(8), "1", "t", "BAC"), ("u", day(20), "2", "t", "CAT")]

    def ids(path):
        return sorted(r.id for r in read_bronze(spark, path).collect())

    for dedupe in (False, True):  # BAC's posts stay below the global mark
        path = f"{tmp_path_str}/per_ticker_{dedupe}"
        bulk_load(posts(spark, first), dim, path)
        for h, i in ((12, "3"), (14, "4"), (16, "5")):
            incremental_load(posts(spark, [("u", day(h), i, "t", "BAC")]), dim, path, per_ticker=True, dedupe=dedupe)
        assert ids(path) == ["1", "2", "3", "4", "5"]
    for dedupe in (False, True):  # posts exactly on the mark
        path = f"{tmp_path_str}/on_mark_{dedupe}"
        bulk_load(posts(spark, first), dim, path)
        for i in ("3", "4"):
            incremental_load(posts(spark, [("u", day(20), i, "t", "BAC")]), dim, path, dedupe=dedupe)
        incremental_load(posts(spark, [("u", day(20), "4", "t", "BAC")]), dim, path, dedupe=dedupe)
        assert ids(path) == ["1", "2", "3", "4"] + ["4"] * (not dedupe)  # K10
    path = f"{tmp_path_str}/named"
    bulk_load(posts(spark, first), dim, path)
    for _ in range(2):  # a repeated load writes the same rows again
        incremental_load(posts(spark, [("u", day(12), "3", "t", "BAC")]), dim, path, per_ticker=True, dedupe=True, load_id="a")
        assert ids(path) == ["1", "2", "3"]


def test_silver_casts_and_weekday(spark):
    pre = spark.createDataFrame([
        ("u", "2021-12-06T10:00:00.000Z", 5, "txt", "CAT", "Caterpillar", "Manufacturing", "2021-12-07", "0.25", date(2021, 12, 6)),
        ("u", "2021-12-06 11:00:00", 6, "txt", "CAT", "Caterpillar", "Manufacturing", "2021-12-07", "oops", date(2021, 12, 6)),
        ("u", "2021-12-04 11:00:00", 7, "txt", "CAT", "Caterpillar", "Manufacturing", "2021-12-07", "1", date(2021, 12, 4)),
    ], "user string, Twitter_Created_datetime string, id int, text string, Ticker string, company string, "
       "CompanySector string, load_date string, sentID string, Tweet_date date")
    s = build_silver(pre)
    assert "user" not in s.columns and "companySector" in s.columns
    rows = sorted(s.collect(), key=lambda r: r.id)
    assert [(r.id, r.Twitter_Created_datetime, r.sentID) for r in rows] == [
        ("5", datetime(2021, 12, 6, 10), 0.25), ("6", datetime(2021, 12, 6, 11), None)]
    assert dict(s.dtypes)["Twitter_Created_datetime"] == "timestamp_ntz"


def test_gold_left_join_sort_and_corrections(spark):
    grid = HourGrid.from_range("2021-12-02 01:30:00", "2021-12-02 03:30:00")  # 3 buckets
    silver = spark.createDataFrame([
        ("2021-12-02 01:45:00", "CAT", "Manufacturing", 1.0),
        ("2021-12-02 02:30:00", "CAT", "Manufacturing", 3.0),   # grid point: buckets ending 02:30 and 03:30
        ("2021-12-02 02:40:00", "CAT", "Banks", 5.0),           # sector mismatch with the bar
    ], "t string, Ticker string, companySector string, sentID double").select(
        F.col("t").cast("timestamp_ntz").alias("Twitter_Created_datetime"), "Ticker", "companySector", "sentID")
    bars = spark.createDataFrame([
        (1, f"2021-12-02 0{h}:30:00", "CAT", "Manufacturing", 1.0, 1.0, 1.0, 1.0, 1.0, 100) for h in range(1, 6)
    ], "index long, d string, Ticker string, CompanySector string, Adj_Close double, Close double, High double, "
       "Low double, Open double, Volume long").select(
        "index", F.col("d").cast("timestamp_ntz").alias("Date"), *[c for c in
        ["Ticker", "CompanySector", "Adj_Close", "Close", "High", "Low", "Open", "Volume"]])
    gold = build_gold(bars, silver, grid).collect()
    assert [r.Date.hour for r in gold] == [1, 2, 3, 4, 5]
    assert [r.sentimentScore for r in gold] == [None, 2.0, 3.0, None, None]
    corr = correction_rows(spark.createDataFrame(gold), "CAT", "2021-12-02 04:30:00").collect()
    assert sorted(r.Date for r in corr) == [datetime(2021, 12, 1, 1, 30), datetime(2021, 12, 1, 4, 30)]


def test_incremental_into_missing_table_loads_everything(spark, tmp_path_str):
    dim = company_dim(spark)
    path = tmp_path_str + "/fresh"
    incremental_load(posts(spark, [("u", datetime(2021, 12, 6, 8), "1", "t", "BAC"),
                                   ("u", datetime(2021, 12, 5, 8), "2", "t", "BAC")]), dim, path)
    assert [r.id for r in read_bronze(spark, path).collect()] == ["1"]  # Sunday dropped


def test_failed_append_is_invisible_and_retry_adds_once(spark, tmp_path_str):
    """A write that breaks off between its tasks and its commit, then a retry."""
    import os

    import pytest

    dim, path = company_dim(spark), tmp_path_str + "/bronze"
    day1 = [("u", datetime(2021, 12, 6, h), str(h), "t", "CAT") for h in range(8, 11)]
    more = day1 + [("u", datetime(2021, 12, 7, h), str(20 + h), "t", "CAT") for h in range(4)]
    bulk_load(posts(spark, day1), dim, path, "2021-12-06")
    broken = F.when(F.col("id") == "23", F.expr("raise_error('boom')")).otherwise(F.col("text"))
    with pytest.raises(Exception, match="boom"):  # some tasks have written their files by then
        incremental_load(posts(spark, more).repartition(4, "id").withColumn("text", broken), dim, path, "2021-12-07")
    assert read_bronze(spark, path).count() == 3
    # as if the driver had died before the commit: files under the load, not published
    load = f"{path}/load=from-20211206T100000000000/_temporary/0/task_x/Tweet_date=2021-12-07"
    os.makedirs(load)
    bronze_frame(posts(spark, more), dim).drop("Tweet_date").write.mode("append").parquet(load)
    assert read_bronze(spark, path).count() == 3
    incremental_load(posts(spark, more), dim, path, "2021-12-07")
    want = ["10", "10", "20", "21", "22", "23", "8", "9"]  # the post on the mark is there again (K10)
    assert sorted(r.id for r in read_bronze(spark, path).collect()) == want
    incremental_load(posts(spark, more), dim, path, "2021-12-07", load_id="from-20211206T100000000000")
    assert read_bronze(spark, path).where("id < '24' and id >= '20'").count() == 1  # that load replaced whole


def test_bulk_load_replaces_all_loads(spark, tmp_path_str):
    dim, path = company_dim(spark), tmp_path_str + "/bronze"
    rows = [("u", datetime(2021, 12, 6, h), str(h), "t", "CAT") for h in range(8, 10)]
    bulk_load(posts(spark, rows), dim, path)
    incremental_load(posts(spark, rows + [("u", datetime(2021, 12, 8, 9), "40", "t", "CAT")]), dim, path)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        bulk_load(posts(spark, [("u", datetime(2021, 12, 7, 8), "2", "t", "CAT")]), dim, path)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r.id for r in read_bronze(spark, path).collect()] == ["2"]


def test_incremental_with_nothing_new(spark, tmp_path_str):
    dim, path = company_dim(spark), tmp_path_str + "/bronze"
    rows = [("u", datetime(2021, 12, 6, h), str(h), "t", "CAT") for h in range(8, 10)]
    bulk_load(posts(spark, rows), dim, path)
    incremental_load(posts(spark, rows[:1]), dim, path)  # older than the mark: nothing to add
    assert read_bronze(spark, path).count() == 2


def test_mark_after_stream_and_load(spark, tmp_path_str):
    from marketpulse.streaming.bronze_stream import stage_posts, stream_to_bronze
    dim, path, stage = company_dim(spark), tmp_path_str + "/bronze", tmp_path_str + "/stage"
    rows = [("u", datetime(2021, 12, 6, h), str(h), "t", "CAT") for h in range(8, 12)]
    bulk_load(posts(spark, rows), dim, path)
    stage_posts(bronze_frame(posts(spark, [("u", datetime(2021, 12, 7, 9, 30), "30", "t", "BAC")]), dim), stage)
    stream_to_bronze(spark, stage, path)
    incremental_load(posts(spark, rows + [("u", datetime(2021, 12, 8, 9), "40", "t", "CAT")]), dim, path)
    assert sorted(r.id for r in read_bronze(spark, path).collect()) == ["10", "11", "30", "40", "8", "9"]


def test_silver_and_gold_tables_roundtrip(spark, tmp_path_str):
    from marketpulse.plans.gold import read_gold, write_gold
    from marketpulse.plans.silver import read_silver, write_silver
    dim = company_dim(spark)
    bronze = bronze_frame(posts(spark, [("u", datetime(2021, 12, 6, 8), "1", "t", "CAT")]), dim, "2021-12-06")
    silver = build_silver(bronze.withColumn("sentID", F.lit(0.5)))
    write_silver(silver, tmp_path_str + "/silver")
    back = read_silver(spark, tmp_path_str + "/silver")
    assert back.schema == silver.schema or back.columns == silver.columns
    assert back.collect() == silver.collect()
    gold = spark.createDataFrame([(None, "CAT", 1.0, 1.0, 1.0, 1.0, 1.0, 5, "Banks", None)],
                                 "Date timestamp_ntz, Ticker string, Adj_Close double, Close double, High double, Low double, "
                                 "Open double, Volume long, CompanySector string, sentimentScore double")
    write_gold(gold, tmp_path_str + "/gold")
    assert read_gold(spark, tmp_path_str + "/gold").collect() == gold.collect()


def test_start_of_day(spark):
    from marketpulse.functions.columns import start_of_day
    df = spark.sql("select timestamp_ntz'2024-03-10 02:30:00' t union all select null")
    assert {r[0] for r in df.select(start_of_day("t")).collect()} == {datetime(2024, 3, 10), None}


def test_building_read_only_queries_starts_no_job_but_schema_lookups(spark):
    from marketpulse.queries import QUERIES
    tracker = spark.sparkContext.statusTracker()
    sf = "/root/testdata/sf0.001"
    for name in ("company_tag", "gold_build", "hourly_sentiment", "keyword_match", "correction_rows", "upsert_orders", "time_grid"):
        spark.sparkContext.setJobGroup(f"plan-{name}", name)
        QUERIES[name](spark, sf)
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(f"plan-{name}")]
        stages = [tracker.getStageInfo(s) for j in jobs if j for s in j.stageIds]
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        # one single-task job per Parquet table for its schema
        assert len(jobs) <= 2 and all(s is None or s.numTasks == 1 for s in stages), name
