"""Gold: hourly sentiment joined to price bars.

silver -> arithmetic bucket assignment (map-only) -> partial/final hash
aggregate per (ticker, sector, hour) -> left join from the bars -> sort.
The aggregate is at most tickers x buckets rows whatever the post volume;
AQE sees its real size at runtime and broadcasts it into the join when small.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketpulse.functions.columns import all_of
from marketpulse.operators.aggregates import hourly_mean
from marketpulse.operators.timegrid import HourGrid, bucket_assign
from marketpulse.plans.bronze import TS
from marketpulse.plans.tables import replace_table
from marketpulse.schemas import BRONZE_PARTITION, GOLD_COLUMNS, GOLD_PARTITION, GOLD_SCHEMA

# The correction rows of the original type-1 demonstration take
# one ticker's unscored bars up to a bound and move them 24 hours back.
REFERENCE_CORRECTION_TICKER = "CAT"
REFERENCE_CORRECTION_UNTIL = "2021-12-04 14:30:00"
CORRECTION_SHIFT = timedelta(hours=24)


def hourly_sentiment(silver: DataFrame, grid: HourGrid, closed: str = "both") -> DataFrame:
    """``Ticker, companySector, enddatetime, sentimentScore`` per grid bucket."""
    if BRONZE_PARTITION in silver.columns:
        # date-partitioned input: read only the partitions the grid can touch
        silver = silver.where(F.col(BRONZE_PARTITION).between(
            F.lit(grid.first_start.date()), F.lit(grid.end.date())))
    posts = silver.select(TS, "Ticker", "companySector", "sentID")
    bucketed = bucket_assign(posts, TS, grid, closed=closed)
    agg = hourly_mean(bucketed, keys=("Ticker", "companySector", "enddatetime"))
    return agg.toDF("Ticker", "companySector", "enddatetime", "sentimentScore")


def join_scores(bars: DataFrame, hourly: DataFrame) -> DataFrame:
    """All bars with the score of their (ticker, sector, close hour), or NULL."""
    agg = hourly.select(F.col("Ticker").alias("_a_ticker"), F.col("companySector").alias("_a_sector"),
                        F.col("enddatetime").alias("_a_end"), "sentimentScore")
    on = all_of([bars["Date"] == agg["_a_end"], bars["Ticker"] == agg["_a_ticker"],
                 bars["CompanySector"] == agg["_a_sector"]])
    return bars.join(agg, on, "left").select(*GOLD_COLUMNS)


def build_gold(bars: DataFrame, silver: DataFrame, grid: HourGrid, closed: str = "both",
               sort: bool = True) -> DataFrame:
    """All bars, each with the mean sentiment of its (ticker, sector, close hour) or NULL."""
    gold = join_scores(bars, hourly_sentiment(silver, grid, closed))
    if sort:
        gold = gold.orderBy(F.col("Ticker").asc_nulls_last(), F.col("Date").asc_nulls_last())
    return gold


def write_gold(gold: DataFrame, path: str) -> None:
    """Replace the gold table (SK3), partitioned by the date of the bar so that a merge rewrites few files."""
    replace_table(gold.withColumn(GOLD_PARTITION, F.to_date("Date")), path, GOLD_PARTITION)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(GOLD_SCHEMA).parquet(path).select(*GOLD_COLUMNS)


def scored_gold(gold: DataFrame) -> DataFrame:
    """Gold rows that carry a sentiment score."""
    return gold.where(F.col("sentimentScore").isNotNull())


def correction_rows(gold: DataFrame, ticker: str = REFERENCE_CORRECTION_TICKER,
                    until: str = REFERENCE_CORRECTION_UNTIL,
                    shift: timedelta = CORRECTION_SHIFT) -> DataFrame:
    """Unscored bars of one ticker up to ``until``, moved ``shift`` back."""
    micros = shift // timedelta(microseconds=1)
    return (gold.where(F.col("sentimentScore").isNull()
                       & (F.col("Ticker") == ticker)
                       & (F.col("Date") <= F.lit(until).cast("timestamp_ntz")))
            .withColumn("Date", F.timestamp_add("MICROSECOND", F.lit(-micros), F.col("Date"))))
