from datetime import date, datetime

from pyspark.sql import functions as F

from marketpulse.operators.aggregates import (
    company_counts, high_water_mark, high_water_mark_value, hourly_mean,
)


def test_hourly_mean_nan_null_and_null_keys_k3_k24(spark):
    rows = [("A", "S", 1, 1.0), ("A", "S", 1, float("nan")), ("A", "S", 1, None), ("A", "S", 1, 3.0),
            ("A", "S", 2, None), (None, "S", 1, 9.0), ("A", None, 1, 9.0)]
    df = spark.createDataFrame(rows, "Ticker string, companySector string, enddatetime int, sentID double")
    got = {(r[0], r[1], r[2]): r[3] for r in hourly_mean(df).collect()}
    assert got == {("A", "S", 1): 2.0, ("A", "S", 2): None}


def test_company_counts_skips_null_key(spark):
    df = spark.createDataFrame([("A",), ("A",), (None,), ("B",)], "ticker string")
    assert dict(company_counts(df).collect()) == {"A": 2, "B": 1}


def test_high_water_mark_iso_and_partition_shortcut(spark, tmp_path_str):
    rows = [(datetime(2021, 12, 3, 10, 0, 0, 5), date(2021, 12, 3)),
            (datetime(2021, 12, 4, 9, 0), date(2021, 12, 4)),
            (datetime(2021, 12, 4, 23, 59, 59), date(2021, 12, 4))]
    df = spark.createDataFrame([(a.isoformat(sep=" "), b) for a, b in rows], "s string, d date") \
        .select(F.col("s").cast("timestamp_ntz").alias("ts"), "d")
    df.write.partitionBy("d").parquet(tmp_path_str + "/t")
    t = spark.read.parquet(tmp_path_str + "/t")
    assert high_water_mark_value(t, "ts", partition_col="d") == high_water_mark_value(t, "ts") \
        == datetime(2021, 12, 4, 23, 59, 59)
    r = high_water_mark(t, "ts").first()
    assert r.hwm_iso == "2021-12-04T23:59:59Z"
    assert high_water_mark_value(t.where("d > '2030-01-01'"), "ts", partition_col="d") is None
