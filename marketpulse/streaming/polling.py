"""Polling increments from the table's own mark, each post once (T4).

A round asks the source for the posts at or after the bronze table's high-water
mark, less a look-back for posts that the source shows late. So rounds overlap on
purpose, and posts come again. What a round fetched is appended to the stage with its
time of arrival; a Structured Streaming query then reads the stage and drops a post
(id and key) that arrived within ``horizon`` before, which it knows from the state
store (``dropDuplicatesWithinWatermark`` on the arrival time). State older than that
is dropped, so it does not grow with the table, and the table is not joined against.

Arrival times never run back, so no post is late for the watermark, whatever its
own time, or without one. The horizon must exceed the time in which the source can show
a post again: the look-back and the longest pause between rounds.

A round that breaks off is resumed by the next: staged files are read once, a
repeated micro-batch sees the state before it and replaces its own folder.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from marketpulse.operators.aggregates import high_water_mark_value
from marketpulse.plans.bronze import TS, bronze_frame, ntz_literal, read_bronze
from marketpulse.plans.tables import path_exists
from marketpulse.schemas import BRONZE_PARTITION, BRONZE_SCHEMA
from marketpulse.streaming.bronze_stream import append_batch, checkpoint_for

ARRIVED = "_arrived"
STAGE_SCHEMA = StructType([*BRONZE_SCHEMA.fields, StructField(ARRIVED, TimestampType())])
POST_KEYS = ("id", "Ticker")


def table_mark(spark: SparkSession, table_path: str) -> datetime | None:
    """The newest event time of the bronze table, None without table or rows."""
    if not path_exists(spark, table_path):
        return None
    return high_water_mark_value(read_bronze(spark, table_path), TS, partition_col=BRONZE_PARTITION)


def fetch_round(posts: DataFrame, mark: datetime | None, look_back: timedelta = timedelta(0)) -> DataFrame:
    """The posts a round asks the source for: from the mark, inclusive, less the look-back."""
    return posts if mark is None else posts.where(F.col("created_at") >= ntz_literal(mark - look_back))


def stage_round(rows: DataFrame, stage_path: str, arrived: datetime) -> None:
    """Append a round's bronze rows to the stage with their time of arrival."""
    stamp = F.timestamp_micros(F.lit(round(arrived.replace(tzinfo=arrived.tzinfo or timezone.utc).timestamp() * 1_000_000)))
    (rows.select(*BRONZE_SCHEMA.fieldNames()).withColumn(ARRIVED, stamp)
     .write.mode("append").parquet(stage_path))


def stream_new_posts(spark: SparkSession, stage_path: str, table_path: str, horizon: timedelta = timedelta(days=7),
                     checkpoint: str | None = None, max_files_per_trigger: int | None = None,
                     sink: Callable[[DataFrame, int], None] | None = None) -> None:
    """Append the staged posts not seen within ``horizon`` to bronze, a load per micro-batch, and stop.

    Rows without id or key are posts of their own and never dropped. ``sink`` replaces the
    append of a batch (rows, batch id).
    """
    checkpoint = checkpoint or checkpoint_for(table_path, "polling")
    reader = spark.readStream.schema(STAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    staged = reader.parquet(stage_path).withWatermark(ARRIVED, f"{round(horizon.total_seconds())} seconds")
    # a row without id or key gets a key of its own
    whole = F.col("id").isNotNull() & F.col("Ticker").isNotNull()
    named = staged.withColumn("_own", F.when(~whole, F.uuid()))
    fresh = named.dropDuplicatesWithinWatermark([*POST_KEYS, "_own"]).drop("_own", ARRIVED)

    def append(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, table_path, checkpoint, batch_id)

    query = (fresh.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
             .foreachBatch(sink or append).start())
    query.awaitTermination()


def poll(posts: DataFrame, dim: DataFrame, stage_path: str, table_path: str, arrived: datetime, run_date=None,
         look_back: timedelta = timedelta(0), horizon: timedelta = timedelta(days=7), **stream) -> datetime | None:
    """One round: mark, fetch, stage, stream. Returns the mark it started from.

    ``posts`` is what the source shows now. Posts staged by a round that broke off are
    streamed first, so the mark counts them.
    """
    spark = posts.sparkSession
    if path_exists(spark, stage_path):
        stream_new_posts(spark, stage_path, table_path, horizon, **stream)
    mark = table_mark(spark, table_path)
    stage_round(bronze_frame(fetch_round(posts, mark, look_back), dim, run_date), stage_path, arrived)
    stream_new_posts(spark, stage_path, table_path, horizon, **stream)
    return mark
