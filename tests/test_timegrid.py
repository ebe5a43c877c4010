import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marketpulse.operators.timegrid import HourGrid, bucket_assign, bucket_join_theta, span_grid


def ts_frame(spark, values):
    rows = [(i, None if v is None else v.isoformat(sep=" ")) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id long, s string").select(
        "id", F.col("s").cast("timestamp_ntz").alias("ts"))


def test_reference_grid_has_671_buckets(spark):
    g = HourGrid.reference()
    assert g.count == 671
    f = g.frame(spark).orderBy("bucket").collect()
    assert f[0].startdatetime == datetime(2021, 12, 2, 1, 30)
    assert f[-1].startdatetime == datetime(2021, 12, 29, 23, 30)
    assert f[-1].enddatetime == datetime(2021, 12, 30, 0, 30)


def test_edge_rows_closed_both_k2_k18(spark):
    g = HourGrid.from_range("2021-12-02 01:30:00", "2021-12-02 04:30:00")  # 4 buckets
    a = datetime(2021, 12, 2, 1, 30)
    vals = [a, a + timedelta(hours=2), a + timedelta(hours=4), a + timedelta(hours=4, seconds=1),
            a - timedelta(microseconds=1), a + timedelta(minutes=90), None]
    out = bucket_assign(ts_frame(spark, vals), "ts", g, bucket_col="bucket")
    got = sorted((r.id, r.bucket) for r in out.collect())
    assert got == [(0, 1), (1, 2), (1, 3), (2, 4), (5, 2)]


@pytest.mark.parametrize("closed,expected", [
    ("right", [(1, 2), (2, 4), (5, 2)]),
    ("left", [(0, 1), (1, 3), (5, 2)]),
])
def test_other_closures(spark, closed, expected):
    g = HourGrid.from_range("2021-12-02 01:30:00", "2021-12-02 04:30:00")
    a = datetime(2021, 12, 2, 1, 30)
    vals = [a, a + timedelta(hours=2), a + timedelta(hours=4), a + timedelta(hours=4, seconds=1),
            a - timedelta(microseconds=1), a + timedelta(minutes=90), None]
    out = bucket_assign(ts_frame(spark, vals), "ts", g, closed=closed, bucket_col="bucket")
    assert sorted((r.id, r.bucket) for r in out.collect()) == expected


@pytest.mark.parametrize("tz", ["UTC", "America/New_York"])
def test_arithmetic_equals_theta_join(spark, tz):
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        rnd = random.Random(7)
        g = HourGrid.from_range("2024-03-08 01:30:00", "2024-03-12 00:00:00")
        a = g.first_start
        vals = [a + timedelta(microseconds=rnd.randrange(-3_600_000_000, 110 * 3_600_000_000))
                for _ in range(3000)]
        vals += [a + timedelta(hours=h) for h in range(-1, 100)]  # every grid point, both ends
        df = ts_frame(spark, vals)
        fast = bucket_assign(df, "ts", g).select("id", "startdatetime", "enddatetime")
        slow = bucket_join_theta(df, "ts", g.frame(spark)).select("id", "startdatetime", "enddatetime")
        assert fast.count() == slow.count()
        assert fast.exceptAll(slow).count() == 0 and slow.exceptAll(fast).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_bucket_assign_is_map_only(spark, capsys):
    g = HourGrid.reference()
    df = ts_frame(spark, [datetime(2021, 12, 3)])
    bucket_assign(df, "ts", g).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "NestedLoop" not in plan


def test_span_grid(spark):
    df = ts_frame(spark, [datetime(2024, 1, 1, 0, 10), datetime(2024, 1, 1, 3, 59)])
    rows = span_grid(df, "ts").orderBy("bucket").collect()
    assert [r.startdatetime for r in rows] == [datetime(2024, 1, 1, h, 30) for h in range(4)]
    assert rows[-1].enddatetime == datetime(2024, 1, 1, 4, 30)


def test_grid_bounds_reach_the_scan(spark, tmp_path_str, capsys):
    from marketpulse.plans.gold import hourly_sentiment
    from marketpulse.plans.silver import read_silver, write_silver
    rows = [(f"2021-12-0{d} 10:00:00", "CAT", "Manufacturing", 1.0) for d in range(1, 9)]
    silver = spark.createDataFrame(rows, "t string, Ticker string, companySector string, sentID double").select(
        F.col("t").cast("timestamp_ntz").alias("Twitter_Created_datetime"), "Ticker", "companySector", "sentID",
        F.to_date(F.col("t").cast("timestamp_ntz")).alias("Tweet_date"))
    write_silver(silver, tmp_path_str + "/silver")
    stored = read_silver(spark, tmp_path_str + "/silver")
    grid = HourGrid.from_range("2021-12-03 01:30:00", "2021-12-04 00:00:00")
    out = hourly_sentiment(stored, grid)
    out.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(Tweet_date" in plan and "2021-12-03" in plan
    assert "GreaterThanOrEqual(Twitter_Created_datetime,2021-12-03T01:30)" in plan
    assert [r.enddatetime for r in out.collect()] == [datetime(2021, 12, 3, 10, 30)]
