from datetime import datetime

from pyspark.sql import functions as F

from marketpulse.plans.bronze import bronze_frame
from marketpulse.plans.catalog import drop_table, read_table, register_path, save_table, use_database
from marketpulse.plans.tables import write_partitioned
from marketpulse.sources.company import company_dim


def _bronze(spark, n, start=0):
    data = [(f"u{i}", datetime(2021, 12, 6 + i % 2, 9).isoformat(sep=" "), str(i), "t", "CAT")
            for i in range(start, start + n)]
    p = spark.createDataFrame(data, "user string, t string, id string, text string, ticker string") \
        .select("user", F.col("t").cast("timestamp_ntz").alias("created_at"), "id", "text", "ticker")
    return bronze_frame(p, company_dim(spark), "2021-12-08")


def test_named_tables_overwrite_append_drop(spark):
    use_database(spark, "market_test")
    try:
        save_table(_bronze(spark, 4), "tweet_bronze", partition_col="Tweet_date")
        save_table(_bronze(spark, 3, start=10), "tweet_bronze", mode="append", partition_col="Tweet_date")
        t = read_table(spark, "tweet_bronze")
        assert t.count() == 7
        assert t.where("Tweet_date = DATE'2021-12-07'").count() == 3
        save_table(_bronze(spark, 2), "tweet_bronze", partition_col="Tweet_date")  # overwrite
        assert read_table(spark, "tweet_bronze").count() == 2
        drop_table(spark, "tweet_bronze")
        assert "tweet_bronze" not in [x.name for x in spark.catalog.listTables("market_test")]
    finally:
        spark.catalog.setCurrentDatabase("default")


def test_register_path(spark, tmp_path_str):
    path = tmp_path_str + "/bronze"
    write_partitioned(_bronze(spark, 5), path, "Tweet_date")
    register_path(spark, "default.bronze_by_path", path)
    assert read_table(spark, "default.bronze_by_path").count() == 5
    drop_table(spark, "default.bronze_by_path")


def test_bucketed_side_of_a_join_does_not_move(spark):
    from pyspark.sql import functions as F

    from marketpulse.plans.catalog import drop_table, read_table, save_bucketed
    from marketpulse.plans.gold import join_scores
    bars = spark.range(500).select(F.timestamp_add("HOUR", F.col("id"), F.lit("2024-01-01 00:30:00").cast("timestamp_ntz")).alias("Date"),
                                   F.concat(F.lit("T"), F.col("id") % 7).alias("Ticker"), F.concat(F.lit("S"), F.col("id") % 2).alias("CompanySector"),
                                   *[F.lit(1.0).alias(c) for c in ("Adj_Close", "Close", "High", "Low", "Open")], F.lit(1).cast("long").alias("Volume"))
    hourly = bars.where("hour(Date) % 3 = 0").select(
        "Ticker", F.col("CompanySector").alias("companySector"), F.col("Date").alias("enddatetime"), F.lit(0.5).alias("sentimentScore"))
    save_bucketed(bars, "bars_bucketed", ["Date", "Ticker", "CompanySector"], 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_scores(read_table(spark, "bars_bucketed"), hourly)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        left = plan[plan.index("SortMergeJoin"):plan.index("bars_bucketed")]
        assert "Exchange" not in left and "Bucketed: true" in plan
        want = join_scores(bars, hourly)
        assert joined.count() == 500 and joined.exceptAll(want).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        drop_table(spark, "bars_bucketed")
