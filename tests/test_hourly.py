"""Hourly means kept by increments against full rebuilds."""

import glob
import os
import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from marketpulse.operators.timegrid import HourGrid
from marketpulse.plans.gold import hourly_sentiment, read_gold
from marketpulse.plans.hourly import add_load, correction, hourly_means, partials, refresh_gold

GRID = HourGrid.from_range("2021-12-02 01:30:00", "2021-12-09 00:00:00")
SCHEMA = "id long, t string, Ticker string, companySector string, sentID double"


def silver(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select(F.col("t").cast("timestamp_ntz").alias("Twitter_Created_datetime"), "Ticker", "companySector", "sentID",
                     F.to_date("t").alias("Tweet_date"))


def posts(n, seed, start=datetime(2021, 12, 2)):
    rnd = random.Random(seed)
    return [(i, (start + timedelta(minutes=30 * rnd.randrange(300))).isoformat(" "), rnd.choice(["A", "B", None]),
             rnd.choice(["S", None]), rnd.choice([None, float("nan"), rnd.uniform(-1, 1), 0.5])) for i in range(n)]


def scores(df):
    return sorted((r.Ticker, r.companySector, r.enddatetime, None if r.sentimentScore is None else round(r.sentimentScore, 9))
                  for r in df.collect())


def test_loads_retries_and_corrections_equal_a_rebuild(spark, tmp_path_str):
    rows = posts(400, 1)
    loads = [rows[:150], rows[150:300], rows[300:]]
    for i, load in enumerate(loads):
        add_load(partials(silver(spark, load), GRID), tmp_path_str, f"l{i}")
    add_load(partials(silver(spark, loads[1]), GRID), tmp_path_str, "l1")  # a repeated attempt
    assert scores(hourly_means(spark, tmp_path_str)) == scores(hourly_sentiment(silver(spark, rows), GRID))
    # new scores, posts taken back whole, a post in another hour
    old = rows[10:60]
    new = [(i, t, k, s, 0.25) for i, t, k, s, _ in old[:20]] + [(i, "2021-12-03 10:30:00", k, s, v) for i, t, k, s, v in old[20:30]]
    dates = add_load(correction(silver(spark, old), silver(spark, new), GRID), tmp_path_str, "fix")
    after = rows[:10] + new + rows[60:]
    assert scores(hourly_means(spark, tmp_path_str)) == scores(hourly_sentiment(silver(spark, after), GRID))
    some = [r for r in scores(hourly_means(spark, tmp_path_str)) if r[2].date() in dates[:2]]
    assert scores(hourly_means(spark, tmp_path_str, dates[:2])) == some


def test_a_correction_back_and_forth_leaves_nothing(spark, tmp_path_str):
    rows = posts(50, 2)
    add_load(partials(silver(spark, rows), GRID), tmp_path_str, "a")
    assert add_load(correction(silver(spark, rows), silver(spark, rows), GRID), tmp_path_str, "b") == []
    add_load(correction(silver(spark, rows), silver(spark, []), GRID), tmp_path_str, "c")
    assert hourly_means(spark, tmp_path_str).count() == 0


def test_only_touched_dates_are_read_and_written(spark, tmp_path_str):
    partial, gold = tmp_path_str + "/p", tmp_path_str + "/g"
    bars = (spark.range(24 * 6).select(F.timestamp_add("HOUR", F.col("id"), F.lit("2021-12-02 02:30:00").cast("timestamp_ntz")).alias("Date"))
            .select("Date", F.lit("A").alias("Ticker"), *[F.lit(1.0).alias(c) for c in ("Adj_Close", "Close", "High", "Low", "Open")],
                    F.lit(1).cast("long").alias("Volume"), F.lit("S").alias("CompanySector")))
    days = [date(2021, 12, d) for d in range(2, 9)]
    rows = posts(300, 3)
    add_load(partials(silver(spark, rows[:200]), GRID), partial, "a")
    refresh_gold(spark, bars, partial, gold, days)
    before = {os.path.basename(os.path.dirname(f)): f for f in glob.glob(f"{gold}/*/*.parquet")}
    late = [(i, "2021-12-04 10:10:00", "A", "S", 0.125) for i in range(3)]
    dates = add_load(partials(silver(spark, late), GRID), partial, "b")
    assert dates == [date(2021, 12, 4)]
    plan = hourly_means(spark, partial, dates)._jdf.queryExecution().executedPlan().toString()
    assert "2021-12-04" in plan.split("PartitionFilters")[1].split("]")[0]
    refresh_gold(spark, bars, partial, gold, dates)
    after = {os.path.basename(os.path.dirname(f)): f for f in glob.glob(f"{gold}/*/*.parquet")}
    changed = [d for d in before if before[d] != after[d]]
    assert len(changed) == 1 and changed[0].endswith("2021-12-04") and before.keys() == after.keys()
    want = {(r[0], r[2]): r[3] for r in scores(hourly_sentiment(silver(spark, rows[:200] + late), GRID))}
    got = {(r.Ticker, r.Date): r.sentimentScore for r in read_gold(spark, gold).collect()}
    for k, v in got.items():
        assert (None if v is None else round(v, 9)) == want.get(k)
