"""Silver: typed, weekday-only posts with their sentiment score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampNTZType, TimestampType

from marketpulse.functions.columns import epoch_ntz, is_weekday, parse_iso_utc, partition_date
from marketpulse.plans.tables import replace_table
from marketpulse.schemas import BRONZE_PARTITION, SILVER_SCHEMA

TS = "Twitter_Created_datetime"
ZONED = r"(Z|[+-]\d{2}:?\d{2})$"


def to_event_time(df: DataFrame, col: str) -> Column:
    """Any time column -> UTC wall-clock TIMESTAMP_NTZ (NULL when unparseable)."""
    dtype = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dtype, TimestampNTZType):
        return c
    if isinstance(dtype, TimestampType):
        return F.timestamp_add("MICROSECOND", F.unix_micros(c), epoch_ntz())
    if isinstance(dtype, StringType):
        return F.when(c.rlike(ZONED), parse_iso_utc(c)).otherwise(c.try_cast("timestamp_ntz"))
    return c.cast("string").try_cast("timestamp_ntz")


def build_silver(pre_silver: DataFrame, weekday_only: bool = True) -> DataFrame:
    """Scored posts -> silver columns.

    The weekday filter runs on the input's date partition first (partition
    pruning), then the date is recomputed from the cast event time; the
    author is dropped; a score that is not a number becomes NULL.
    """
    df = pre_silver.where(is_weekday(BRONZE_PARTITION)) if weekday_only else pre_silver
    sector = "companySector" if "companySector" in df.columns else "CompanySector"
    ts = to_event_time(df, TS)
    return df.select(
        ts.alias(TS),
        F.col("id").cast("string").alias("id"),
        F.col("text").cast("string").alias("text"),
        F.col("Ticker").cast("string").alias("Ticker"),
        F.col("company").cast("string").alias("company"),
        F.col(sector).cast("string").alias("companySector"),
        F.col("load_date").try_cast("date").alias("load_date"),
        F.col("sentID").try_cast("double").alias("sentID"),
        partition_date(ts).alias(BRONZE_PARTITION),
    )


def write_silver(silver: DataFrame, path: str) -> None:
    """Replace the silver table, partitioned by date."""
    replace_table(silver, path, BRONZE_PARTITION)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SILVER_SCHEMA).parquet(path)
