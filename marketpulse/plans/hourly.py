"""Hourly sentiment kept up by increments (A1, SK3), without rebuilding the past.

The table holds mergeable partial aggregates per (ticker, sector, bucket end): the
sum of the scores, how many there are, and how many posts. Loads only add rows to it,
each in a folder of its own (``plans.tables``), partitioned by the date of
the bucket end; a repeated attempt replaces its own folder. A correction is a load
too: it takes the old scores back (negative counts and sums) and adds the new
ones. Nothing written is read to write the next load.

The mean of a bucket is the sum over the loads, divided; a bucket whose posts
have all been taken back is gone. A reader names the dates it needs and reads the
partial aggregates of these dates alone; gold is refreshed by rewriting just the dates
that loads touched, which are the names of their folders.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

from marketpulse.functions.columns import nan_to_null
from marketpulse.operators.timegrid import HourGrid, bucket_assign
from marketpulse.plans.bronze import TS
from marketpulse.plans.gold import join_scores
from marketpulse.plans.tables import LOAD, path_exists, read_loads, replace_partitions, write_load
from marketpulse.schemas import BRONZE_PARTITION, GOLD_PARTITION

DAY = "bucket_date"
KEYS = ("Ticker", "companySector", "enddatetime")
PARTIAL_SCHEMA = StructType([
    StructField("Ticker", StringType()),
    StructField("companySector", StringType()),
    StructField("enddatetime", TimestampNTZType()),
    StructField("score_sum", DoubleType()),
    StructField("n_scores", LongType()),
    StructField("n_posts", LongType()),
])


def partials(silver: DataFrame, grid: HourGrid, closed: str = "both") -> DataFrame:
    """Partial aggregates of scored posts; posts without ticker or sector count nowhere."""
    if BRONZE_PARTITION in silver.columns:
        silver = silver.where(F.col(BRONZE_PARTITION).between(F.lit(grid.first_start.date()), F.lit(grid.end.date())))
    rows = bucket_assign(silver.select(TS, "Ticker", "companySector", "sentID"), TS, grid, closed=closed)
    score = nan_to_null("sentID")
    return (rows.na.drop(subset=list(KEYS)).groupBy(*KEYS)
            .agg(F.coalesce(F.sum(score), F.lit(0.0)).alias("score_sum"), F.count(score).alias("n_scores"),
                 F.count(F.lit(1)).alias("n_posts")))


def _merged(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in ("score_sum", "n_scores", "n_posts")])


def correction(old: DataFrame, new: DataFrame, grid: HourGrid, closed: str = "both") -> DataFrame:
    """Partial aggregates that take the posts ``old`` back and add ``new``; buckets where nothing changes are left out."""
    back = partials(old, grid, closed)
    back = back.select(*KEYS, *[(-F.col(c)).alias(c) for c in ("score_sum", "n_scores", "n_posts")])
    both = _merged(back.unionByName(partials(new, grid, closed)))
    return both.where((F.col("score_sum") != 0) | (F.col("n_scores") != 0) | (F.col("n_posts") != 0))


def add_load(rows: DataFrame, path: str, load_id: str) -> list[date]:
    """Write partial aggregates as one load; returns the dates it touched."""
    write_load(rows.withColumn(DAY, F.to_date("enddatetime")), path, load_id, DAY)
    return load_dates(rows.sparkSession, path, [load_id])


def _table(spark: SparkSession, path: str) -> DataFrame:
    return read_loads(spark, path, StructType([*PARTIAL_SCHEMA.fields, StructField(DAY, StringType())]))


def load_dates(spark: SparkSession, path: str, load_ids: list[str]) -> list[date]:
    """The dates of loads: their folders' names, at most one value per calendar day."""
    found = set()
    for load in load_ids:
        folder = f"{path}/{LOAD}={load}"
        if path_exists(spark, folder):
            rows = spark.read.schema(StructType([*PARTIAL_SCHEMA.fields, StructField(DAY, StringType())])).parquet(folder)
            found |= {date.fromisoformat(r[0]) for r in rows.select(DAY).distinct().collect() if r[0]}
    return sorted(found)


def hourly_means(spark: SparkSession, path: str, dates: list[date] | None = None) -> DataFrame:
    """``Ticker, companySector, enddatetime, sentimentScore`` of all loads, or of the given dates alone."""
    rows = _table(spark, path)
    if dates is not None:
        rows = rows.where(F.col(DAY).isin([d.isoformat() for d in dates]))
    mean = F.when(F.col("n_scores") > 0, F.col("score_sum") / F.col("n_scores"))
    return _merged(rows).where(F.col("n_posts") > 0).select(*KEYS, mean.alias("sentimentScore"))


def refresh_gold(spark: SparkSession, bars: DataFrame, path: str, gold_path: str, dates: list[date]) -> None:
    """Rewrite the gold rows of the given dates from the bars and the partial aggregates of these dates.

    Gold itself is not read. ``dates`` are those that loads touched, or that bars were added for; a gold date
    whose bars are all gone keeps its rows.
    """
    if not dates:
        return
    days = F.to_date("Date").isin(dates)
    gold = join_scores(bars.where(days), hourly_means(spark, path, dates))
    replace_partitions(gold.withColumn(GOLD_PARTITION, F.to_date("Date")), gold_path, GOLD_PARTITION)
