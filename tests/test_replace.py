"""Writes that fail or break off leave the old rows, or are finished later."""

import os

import pytest
from pyspark.sql import functions as F

import marketpulse.plans.tables as T
from marketpulse.plans.gold import read_gold, write_gold
from marketpulse.plans.tables import finish_moves, replace_partitions, replace_table, write_load


def rows(spark, n, tag, days=3):
    return spark.range(n).select("id", F.lit(tag).alias("tag"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % days).cast("int")).alias("d"))


def failing(spark):
    """Fails while it is written."""
    return rows(spark, 50, "bad").withColumn("tag", F.when(F.rand() < 2, F.raise_error(F.lit("no disk"))).cast("string"))


def tags(spark, path, of="tag"):
    return {r[0]: r[1] for r in spark.read.parquet(path).groupBy(of).count().collect()}


def left_behind(path):
    name = os.path.basename(path)
    return [f for f in os.listdir(os.path.dirname(path)) if f.startswith(f"_{name}.")]


@pytest.mark.parametrize("replace", [lambda df, p: replace_table(df, p, "d"), lambda df, p: replace_partitions(df, p, "d"),
                                     lambda df, p: T.replace_loads(df, p, "bulk", "d")])
def test_a_failed_overwrite_leaves_the_old_rows(spark, tmp_path_str, monkeypatch, replace):
    path = tmp_path_str + "/t"
    replace(rows(spark, 100, "old"), path)
    real = T.write_partitioned

    def fails_in_the_write_stage(df, folder, *cols):
        real(df, folder, *cols)  # files are there, but the job did not commit
        os.remove(f"{folder}/_SUCCESS")
        raise RuntimeError("lost an executor too many")

    with pytest.raises(Exception, match="no disk"):
        replace(failing(spark), path)
    assert tags(spark, path) == {"old": 100}
    monkeypatch.setattr(T, "write_partitioned", fails_in_the_write_stage)
    with pytest.raises(RuntimeError):
        replace(rows(spark, 10, "half"), path)
    assert tags(spark, path) == {"old": 100} and left_behind(path)
    monkeypatch.undo()
    replace(rows(spark, 7, "new", days=3), path)
    assert tags(spark, path) == {"new": 7} and not left_behind(path)


@pytest.mark.parametrize("breaks_at", [1, 2, 3, 4])
def test_moves_that_break_off_are_finished(spark, tmp_path_str, monkeypatch, breaks_at):
    path = tmp_path_str + "/t"
    replace_table(rows(spark, 90, "old"), path, "d")
    real, done = T._move, []

    def lost(spark, source, target):
        done.append(source)
        if len(done) == breaks_at:
            raise KeyboardInterrupt
        real(spark, source, target)

    monkeypatch.setattr(T, "_move", lost)
    with pytest.raises(KeyboardInterrupt):
        replace_partitions(rows(spark, 20, "new", days=2), path, "d")
    monkeypatch.undo()
    finish_moves(spark, path)
    assert tags(spark, path) == {"new": 20, "old": 30} and tags(spark, path, "d").keys().__len__() == 3
    done.clear()
    if breaks_at < 3:
        monkeypatch.setattr(T, "_move", lost)
        with pytest.raises(KeyboardInterrupt):
            replace_table(rows(spark, 5, "newest"), path, "d")
        monkeypatch.undo()
        finish_moves(spark, path)
        assert tags(spark, path) == {"newest": 5}
    assert not left_behind(path)


def test_a_table_is_read_for_its_own_replacement(spark, tmp_path_str):
    path = tmp_path_str + "/t"
    replace_table(rows(spark, 30, "old"), path, "d")
    again = spark.read.parquet(path).withColumn("tag", F.lit("new"))
    replace_partitions(again.where("d > '2024-01-01'"), path, "d")
    assert tags(spark, path) == {"old": 10, "new": 20}
    replace_table(spark.read.parquet(path).withColumn("tag", F.lit("all")), path, "d")
    assert tags(spark, path) == {"all": 30}


def test_a_load_given_again_and_failing_keeps_its_rows(spark, tmp_path_str):
    path = tmp_path_str + "/t"
    write_load(rows(spark, 10, "old"), path, "a", "d")
    with pytest.raises(Exception, match="no disk"):
        write_load(failing(spark), path, "a", "d")
    assert tags(spark, path) == {"old": 10}
    write_load(rows(spark, 4, "new"), path, "a", "d")
    assert tags(spark, path) == {"new": 4}


def test_gold_is_replaced_whole(spark, tmp_path_str):
    bar = spark.sql("""SELECT timestamp_ntz'2024-01-01 10:30:00' AS Date, 'A' AS Ticker, 1D AS Adj_Close, 1D AS Close, 1D AS High,
                       1D AS Low, 1D AS Open, 1L AS Volume, 'S' AS CompanySector, 0.5D AS sentimentScore""")
    write_gold(bar, tmp_path_str + "/g")
    write_gold(bar.withColumn("Ticker", F.lit("B")), tmp_path_str + "/g")
    assert [r.Ticker for r in read_gold(spark, tmp_path_str + "/g").collect()] == ["B"]
