"""Polling rounds: marks, overlap, restarts, each post once."""

from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from marketpulse.plans.bronze import read_bronze
from marketpulse.sources.company import company_dim
from marketpulse.streaming.bronze_stream import append_batch, checkpoint_for
from marketpulse.streaming.polling import poll, stream_new_posts, table_mark

T0 = datetime(2024, 1, 1, 12)


def posts(spark, n, extra=()):
    rows = [(f"u{i}", (T0 + timedelta(hours=i)).isoformat(" "), str(i), f"t{i}", ["BAC", "CAT"][i % 2]) for i in range(n)]
    rows += list(extra)
    return spark.createDataFrame(rows, "user string, s string, id string, text string, ticker string").select(
        "user", F.col("s").cast("timestamp_ntz").alias("created_at"), "id", "text", "ticker").repartition(3)


def ids(spark, table):
    return sorted((r.id or "", r.text) for r in read_bronze(spark, table).collect())


def test_rounds_overlap_and_each_post_comes_once(spark, tmp_path_str):
    stage, table, dim = tmp_path_str + "/stage", tmp_path_str + "/bronze", company_dim(spark)
    look = timedelta(hours=5)
    assert poll(posts(spark, 20), dim, stage, table, T0, "2024-02-01", look) is None
    # a late post within the look-back, and posts of no id at the same time
    late = [("u", (T0 + timedelta(hours=16, minutes=1)).isoformat(" "), "late", "late", "CAT")]
    none = [("u", (T0 + timedelta(hours=25)).isoformat(" "), None, f"no id {k}", "BAC") for k in (1, 2)]
    mark = poll(posts(spark, 30, late + none), dim, stage, table, T0 + timedelta(days=1), "2024-02-01", look, max_files_per_trigger=1)
    assert mark == T0 + timedelta(hours=19)
    assert poll(posts(spark, 30, late), dim, stage, table, T0 + timedelta(days=2), "2024-02-01", look) == T0 + timedelta(hours=29)
    want = sorted([(str(i), f"t{i}") for i in range(30)] + [("late", "late"), ("", "no id 1"), ("", "no id 2")])
    assert ids(spark, table) == want
    staged = spark.read.parquet(stage).count()
    assert staged > len(want)  # the rounds did overlap


def test_round_that_breaks_off_is_resumed(spark, tmp_path_str):
    stage, table, dim = tmp_path_str + "/stage", tmp_path_str + "/bronze", company_dim(spark)
    done = []

    def breaks(batch, batch_id):
        append_batch(batch, table, checkpoint_for(table, "polling"), batch_id)  # written, but the batch is not committed
        done.append(batch_id)
        if len(done) == 2:
            raise RuntimeError("lost")

    with pytest.raises(StreamingQueryException):
        poll(posts(spark, 40), dim, stage, table, T0, "2024-02-01", max_files_per_trigger=1, sink=breaks)
    assert 0 < len(ids(spark, table)) < 40
    mark = poll(posts(spark, 50), dim, stage, table, T0 + timedelta(hours=1), "2024-02-01", timedelta(days=9), max_files_per_trigger=1)
    assert mark == T0 + timedelta(hours=39)  # the staged rest was streamed before the mark was read
    assert ids(spark, table) == sorted((str(i), f"t{i}") for i in range(50))
    stream_new_posts(spark, stage, table)  # nothing new
    assert len(ids(spark, table)) == 50 and table_mark(spark, table) == T0 + timedelta(hours=49)


def test_state_beyond_the_horizon_is_dropped(spark, tmp_path_str):
    """A post shown again long after its horizon is taken for a new one: the state does not grow for ever."""
    stage, table, dim = tmp_path_str + "/stage", tmp_path_str + "/bronze", company_dim(spark)
    for day in (0, 1, 30, 31, 32):
        poll(posts(spark, 2 + day), dim, stage, table, T0 + timedelta(days=day), "2024-02-01", timedelta(days=99), timedelta(days=3))
    assert ids(spark, table).count(("0", "t0")) == 2
    assert ids(spark, table).count(("20", "t20")) == 1


def test_no_table_no_mark(spark, tmp_path_str):
    assert table_mark(spark, tmp_path_str + "/none") is None


def test_files_of_a_batch_follow_its_bytes(spark, tmp_path_str):
    """A date of a small load is one file, however many partitions the state has."""
    stage, table = tmp_path_str + "/stage", tmp_path_str + "/bronze"
    poll(posts(spark, 200), company_dim(spark), stage, table, T0, "2024-02-01")
    files = [(r.Tweet_date, r.file) for r in read_bronze(spark, table)
             .select("Tweet_date", F.input_file_name().alias("file")).distinct().collect()]
    assert len(files) == len({day for day, _ in files}) > 8
    assert len(ids(spark, table)) == 200
