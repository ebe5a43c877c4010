"""Adapters from the driver's test tables to this pipeline's layers.

``events`` plays the post stream: ``ts`` = creation time, ``event_type`` =
search key (mapped to a ticker below), ``value`` = sentiment score,
``user_id`` = author, ``event_id`` = post id, ``props`` = post text. Hourly
price bars are derived from the same events, so every layer grows with the
input tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketpulse.functions.columns import case_map, epoch_micros, floor_to, partition_date
from marketpulse.operators.tagging import tag_company
from marketpulse.schemas import BRONZE_PARTITION

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed test mapping: each event type stands for the search of one company.
EVENT_TICKERS = [
    ("click", "BAC"),
    ("view", "CAT"),
    ("purchase", "ENPH"),
    ("signup", "DVN"),
    ("error", "IVV"),
]
# Posts are landed in pages of consecutive ids: page = event_id div 100, so a
# page never holds more than the source's page size.
EVENT_PAGE_WIDTH = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ticker_of(event_type) -> Column:
    return case_map(event_type, EVENT_TICKERS, None)


def posts_from_events(events: DataFrame) -> DataFrame:
    """``user, created_at, id, text, ticker, sentID, page`` from events."""
    return events.select(
        F.col("user_id").cast("string").alias("user"),
        F.col("ts").alias("created_at"),
        F.col("event_id").cast("string").alias("id"),
        F.col("props").alias("text"),
        ticker_of(F.col("event_type")).alias("ticker"),
        F.col("value").alias("sentID"),
        F.expr(f"event_id div {EVENT_PAGE_WIDTH}").alias("page"),
    )


def scored_posts(events: DataFrame, dim: DataFrame, run_date: str) -> DataFrame:
    """The scored pre-silver layer of the events."""
    return scored_from_posts(posts_from_events(events), dim, run_date)


def scored_from_posts(posts: DataFrame, dim: DataFrame, run_date: str) -> DataFrame:
    """Bronze columns plus ``sentID``."""
    tagged = tag_company(posts, dim)
    return tagged.select(
        "user",
        F.col("created_at").alias("Twitter_Created_datetime"),
        "id", "text",
        F.col("ticker").alias("Ticker"),
        "company", "CompanySector",
        F.lit(run_date).cast("date").alias("load_date"),
        "sentID",
        partition_date("created_at").alias(BRONZE_PARTITION),
    )


HOUR_MICROS = 3_600_000_000


def bar_time(ts) -> Column:
    """Close time of the hourly bar holding ``ts``: bars cover [hh:30, hh+1:30)."""
    start = floor_to(F.col(ts), HOUR_MICROS, anchor_micros=HOUR_MICROS // 2)
    return F.timestamp_add("MICROSECOND", F.lit(HOUR_MICROS), start)


def bars_from_events(events: DataFrame, dim: DataFrame) -> DataFrame:
    """Hourly OHLCV bars per ticker from event values (the price-bar input)."""
    posts = tag_company(posts_from_events(events), dim)
    order = F.struct("created_at", F.col("id").cast("long"))  # posts of one instant: by id
    bars = (posts.groupBy("ticker", "CompanySector", bar_time("created_at").alias("Date"))
            .agg(F.min_by("sentID", order).alias("Open"),
                 F.max("sentID").alias("High"),
                 F.min("sentID").alias("Low"),
                 F.max_by("sentID", order).alias("Close"),
                 F.count(F.lit(1)).alias("Volume")))
    return bars.select(
        F.floor(epoch_micros("Date") / F.lit(HOUR_MICROS)).cast("long").alias("index"),
        "Date",
        F.col("ticker").alias("Ticker"),
        "CompanySector",
        F.col("Close").alias("Adj_Close"),
        "Close", "High", "Low", "Open", "Volume",
    )
