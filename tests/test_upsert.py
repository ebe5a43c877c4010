from datetime import datetime

import pytest
from pyspark.sql import functions as F

from marketpulse.operators.upsert import upsert_type1
from marketpulse.plans.gold import read_gold, write_gold
from marketpulse.plans.upserts import merge_gold
from marketpulse.schemas import GOLD_COLUMNS, GOLD_KEYS, GOLD_MEASURES

SCHEMA = ("Date timestamp_ntz, Ticker string, Adj_Close double, Close double, High double, Low double, "
          "Open double, Volume long, CompanySector string, sentimentScore double")
D = [datetime(2021, 12, 2, h, 30) for h in range(1, 9)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def bar(d, t, px, vol=10, sector="Manufacturing", score=None):
    return (d, t, px, px, px, px, px, vol, sector, score)


@pytest.fixture
def target(spark):
    return frame(spark, [bar(D[0], "CAT", 1.0), bar(D[1], "CAT", 2.0), bar(D[2], "CAT", 3.0, score=None),
                         bar(D[3], "CAT", 4.0), bar(D[4], "CAT", 5.0, score=0.5)])


@pytest.fixture
def source(spark):
    return frame(spark, [
        bar(D[0], "CAT", 1.0),                           # unchanged -> copy
        bar(D[1], "CAT", 2.5),                           # changed measure -> update
        bar(D[2], "CAT", 3.0, score=0.7),                # only NULL -> value: unknown -> no update (K12)
        bar(D[3], "CAT", 4.0, sector="Banks"),           # changed sector only -> no update (K13)
        bar(D[6], "CAT", 7.0),                           # new key -> insert
        bar(D[7], None, 8.0),                            # NULL key -> insert (K21)
    ])


def result(df):
    return {(r.Date, r.Ticker): r for r in df.collect()}


def test_fixture_rows(spark, target, source):
    out = upsert_type1(target, source, GOLD_KEYS, GOLD_MEASURES, GOLD_COLUMNS)
    got = result(out)
    assert len(got) == 7  # 5 target rows + 2 inserts
    assert got[(D[0], "CAT")]._change == "copy"
    assert got[(D[1], "CAT")]._change == "update" and got[(D[1], "CAT")].Close == 2.5
    assert got[(D[2], "CAT")]._change == "copy" and got[(D[2], "CAT")].sentimentScore is None
    assert got[(D[3], "CAT")]._change == "copy" and got[(D[3], "CAT")].CompanySector == "Manufacturing"
    assert got[(D[4], "CAT")]._change == "copy" and got[(D[4], "CAT")].sentimentScore == 0.5
    assert got[(D[6], "CAT")]._change == "insert"
    assert got[(D[7], None)]._change == "insert" and got[(D[7], None)].Close == 8.0


def test_null_safe_option(spark, target, source):
    got = result(upsert_type1(target, source, GOLD_KEYS, GOLD_MEASURES, GOLD_COLUMNS, null_safe=True))
    assert got[(D[2], "CAT")]._change == "update" and got[(D[2], "CAT")].sentimentScore == 0.7


def test_duplicate_source_rows_for_one_target_key_k20(spark, target):
    src = frame(spark, [bar(D[1], "CAT", 9.0), bar(D[1], "CAT", 9.5)])
    with pytest.raises(Exception, match="several source rows match one target row"):
        upsert_type1(target, src, GOLD_KEYS, GOLD_MEASURES, GOLD_COLUMNS).count()  # whatever columns are used
    # two rows of a key that the target lacks, and two without key, are inserts
    new = frame(spark, [bar(D[7], "CAT", 9.0), bar(D[7], "CAT", 9.5), bar(D[1], None, 1.0), bar(D[1], None, 1.0)])
    out = upsert_type1(target, new, GOLD_KEYS, GOLD_MEASURES, GOLD_COLUMNS)
    assert out.where("_change = 'insert'").count() == 4 and out.count() == 9


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_merge_rewrites_only_touched_dates(spark, tmp_path):
    path = tmp_path / "gold"
    days = [datetime(2021, 12, d, 9, 30) for d in range(1, 6)]
    write_gold(frame(spark, [bar(d, "CAT", 1.0) for d in days] + [bar(None, "CAT", 3.0)]), str(path))
    before = files(path)
    src = frame(spark, [bar(days[1], "CAT", 5.0), bar(days[2], "DE", 6.0), bar(datetime(2022, 1, 1, 9, 30), "CAT", 7.0)])
    assert merge_gold(spark, str(path), src) == {"source": 3, "insert": 2, "update": 1, "copy": 1}
    after = files(path)
    kept = {f for f in before if after.get(f) == before[f]}
    assert {f.split("/")[0] for f in kept} == {"Gold_date=2021-12-01", "Gold_date=2021-12-04", "Gold_date=2021-12-05",
                                               "Gold_date=__HIVE_DEFAULT_PARTITION__"}
    assert {f.split("/")[0] for f in set(after) - kept} == {"Gold_date=2021-12-02", "Gold_date=2021-12-03",
                                                            "Gold_date=2022-01-01"}
    got = {(r.Date, r.Ticker): r.Close for r in read_gold(spark, str(path)).collect()}
    assert len(got) == 8 and got[(days[1], "CAT")] == 5.0 and got[(days[2], "DE")] == 6.0 and got[(None, "CAT")] == 3.0


def test_merge_again_and_null_dates(spark, target, source, tmp_path_str):
    path = tmp_path_str + "/gold"
    write_gold(target, path)
    assert merge_gold(spark, path, source) == {"source": 6, "insert": 2, "update": 1, "copy": 4}
    once = read_gold(spark, path).collect()
    # with keys throughout, the same source again is a no-op; rows without key are inserted once more
    assert merge_gold(spark, path, source.where("Ticker IS NOT NULL")) == {"source": 5, "insert": 0, "update": 0, "copy": 7}
    assert sorted(map(repr, read_gold(spark, path).collect())) == sorted(map(repr, once))
    assert merge_gold(spark, path, source)["insert"] == 1
    undated = frame(spark, [bar(None, "CAT", 1.0)])
    assert merge_gold(spark, path, undated)["insert"] == 1
    assert merge_gold(spark, path, undated) == {"source": 1, "insert": 1, "update": 0, "copy": 1}
    assert read_gold(spark, path).where("Date IS NULL").count() == 2
    assert merge_gold(spark, path, undated.limit(0)) == {"source": 0, "insert": 0, "update": 0, "copy": 0}


def test_failed_merge_leaves_the_table(spark, target, tmp_path):
    path = tmp_path / "gold"
    write_gold(target, str(path))
    before = files(path)
    with pytest.raises(Exception, match="several source rows"):
        merge_gold(spark, str(path), frame(spark, [bar(D[1], "CAT", 9.0), bar(D[1], "CAT", 9.5)]))
    assert files(path) == before and read_gold(spark, str(path)).count() == target.count()


def test_updated_columns_keep_target_types(spark, target):
    src = frame(spark, [bar(D[1], "CAT", 2.5)]).withColumn("Volume", F.lit(7).cast("int"))
    out = upsert_type1(target, src, GOLD_KEYS, GOLD_MEASURES, GOLD_COLUMNS)
    assert dict(out.dtypes)["Volume"] == "bigint"
    assert result(out)[(D[1], "CAT")].Volume == 7
