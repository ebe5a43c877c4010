from datetime import datetime

from pyspark.sql import functions as F

from marketpulse.plans.bronze import bronze_frame, read_bronze
from marketpulse.sources.company import company_dim
from marketpulse.streaming.bronze_stream import append_batch, stage_posts, stream_to_bronze


def rows(spark, start, n):
    data = [(f"u{i}", datetime(2021, 12, 6 + i % 3, i % 24).isoformat(sep=" "), str(i), f"t{i}",
             ["BAC", "CAT"][i % 2]) for i in range(start, start + n)]
    p = spark.createDataFrame(data, "user string, t string, id string, text string, ticker string") \
        .select("user", F.col("t").cast("timestamp_ntz").alias("created_at"), "id", "text", "ticker")
    return bronze_frame(p, company_dim(spark), "2021-12-09")


def test_stream_equals_batch_and_rerun_adds_nothing(spark, tmp_path_str):
    stage, table = tmp_path_str + "/stage", tmp_path_str + "/bronze"
    a, b = rows(spark, 0, 30), rows(spark, 30, 20)
    stage_posts(a, stage)
    stream_to_bronze(spark, stage, table, max_files_per_trigger=1)
    assert read_bronze(spark, table).count() == 30
    stream_to_bronze(spark, stage, table)          # nothing new staged: nothing appended
    assert read_bronze(spark, table).count() == 30
    stage_posts(b, stage)
    stream_to_bronze(spark, stage, table)
    got = read_bronze(spark, table)
    want = a.unionByName(b)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_repeated_batch_replaces_itself(spark, tmp_path_str):
    """A batch that ran and was not recorded runs again; NULL and repeated ids stay as staged."""
    table, checkpoint = tmp_path_str + "/bronze", tmp_path_str + "/ckpt"
    batch = rows(spark, 0, 25)
    blank = batch.withColumn("id", F.lit(None).cast("string")).unionByName(batch.limit(5)).unionByName(batch.limit(5))
    append_batch(blank, table, checkpoint, 0)
    append_batch(blank, table, checkpoint, 0)
    assert read_bronze(spark, table).count() == 35
    append_batch(blank, table, checkpoint, 1)
    append_batch(blank, table, checkpoint + "-other", 0)
    assert read_bronze(spark, table).count() == 105


def test_time_limit_is_optional(spark, tmp_path_str):
    import inspect

    assert inspect.signature(stream_to_bronze).parameters["timeout_s"].default is None
    stage, table = tmp_path_str + "/stage", tmp_path_str + "/bronze"
    stage_posts(rows(spark, 0, 5), stage)
    stream_to_bronze(spark, stage, table, timeout_s=300)
    assert read_bronze(spark, table).count() == 5
