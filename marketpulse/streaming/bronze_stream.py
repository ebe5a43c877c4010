"""Stream staged posts into bronze (S8, SK4, T1-T4).

The stage is an append-only folder of typed bronze rows. A Structured
Streaming query reads it with a declared schema and, with
``trigger(availableNow=True)``, processes everything available in one or more
micro-batches and stops. Each batch goes through ``foreachBatch`` and becomes
one load of the bronze table, named after the checkpoint and the batch id.

Idempotence: a micro-batch may run again after a failure (at-least-once); the
repeated batch replaces its own folder whole, so it adds nothing twice, and
no batch reads the table. Rows are appended as staged, repeated or NULL ids
included. The checkpoint lies beside the table and is derived from its path,
so a restart continues where it stopped; a stream with another checkpoint is
another stream and appends all staged rows again.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from hashlib import sha256

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from marketpulse.plans.tables import read_loads, write_load
from marketpulse.schemas import BRONZE_PARTITION, BRONZE_SCHEMA


AUDIT_DAY = "first_date"
AUDIT_SCHEMA = StructType([
    StructField("stream", StringType()), StructField("batch", LongType()), StructField("posts", LongType()),
    StructField("keys", LongType()), StructField("first_post", TimestampNTZType()), StructField("last_post", TimestampNTZType()),
])


def stage_posts(bronze_rows: DataFrame, stage_path: str) -> None:
    """Append typed bronze rows to the stage folder (never overwritten)."""
    bronze_rows.select(*BRONZE_SCHEMA.fieldNames()).write.mode("append").parquet(stage_path)


def checkpoint_for(table_path: str, name: str = "stream") -> str:
    return f"{table_path.rstrip('/')}_checkpoints/{name}"


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution within it. Streams run without, and a write then ignores its ``rebalance`` hint."""
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def append_batch(batch: DataFrame, table_path: str, checkpoint: str, batch_id: int) -> None:
    """One micro-batch as one load; running it again replaces it.

    Its rows are rebalanced by date, so files follow its bytes, not state partitions times dates.
    """
    stream = sha256(checkpoint.encode()).hexdigest()[:12]
    with adaptive(batch.sparkSession):
        write_load(batch, table_path, f"stream-{stream}-{batch_id:010d}", BRONZE_PARTITION)


def stream_to_bronze(spark: SparkSession, stage_path: str, table_path: str,
                     checkpoint: str | None = None, max_files_per_trigger: int | None = None,
                     timeout_s: float | None = None) -> dict:
    """Process all staged rows not yet seen, then stop; returns the last progress.

    By default the stream runs until the backlog is done, however long that
    takes; with ``timeout_s`` it is stopped then and raises, and the next
    call continues.
    """
    checkpoint = checkpoint or checkpoint_for(table_path)
    reader = spark.readStream.schema(BRONZE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    query = (reader.parquet(stage_path).writeStream
             .trigger(availableNow=True)
             .option("checkpointLocation", checkpoint)
             .foreachBatch(lambda df, batch_id: append_batch(df, table_path, checkpoint, batch_id))
             .start())
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"stream into {table_path} did not finish in {timeout_s}s")
    err = query.exception()
    if err is not None:
        raise RuntimeError(f"stream into {table_path} failed: {err}")
    return query.lastProgress or {}


def audited_append(batch: DataFrame, table_path: str, audit_path: str, checkpoint: str, batch_id: int) -> None:
    """One micro-batch as one load, and what it held as a row of the audit table.

    The numbers are observed while the batch is written, without another pass; the row is
    a load under the same name, so a repeated batch replaces both.
    """
    spark, ts = batch.sparkSession, F.col("Twitter_Created_datetime")
    seen = Observation()
    append_batch(batch.observe(seen, F.count(F.lit(1)).alias("posts"), F.count("Ticker").alias("keys"),
                               F.min(ts.cast("string")).alias("first"), F.max(ts.cast("string")).alias("last")),
                 table_path, checkpoint, batch_id)
    n, stream = seen.get, sha256(checkpoint.encode()).hexdigest()[:12]
    row = spark.range(1).select(
        F.lit(stream).alias("stream"), F.lit(batch_id).cast("bigint").alias("batch"), F.lit(n["posts"]).cast("bigint").alias("posts"),
        F.lit(n["keys"]).cast("bigint").alias("keys"), F.lit(n["first"]).cast("timestamp_ntz").alias("first_post"),
        F.lit(n["last"]).cast("timestamp_ntz").alias("last_post"))
    write_load(row.withColumn(AUDIT_DAY, F.to_date("first_post")), audit_path, f"stream-{stream}-{batch_id:010d}", AUDIT_DAY)


def read_audit(spark: SparkSession, audit_path: str) -> DataFrame:
    """One row per micro-batch: posts, posts with a key, first and last event time."""
    return read_loads(spark, audit_path, AUDIT_SCHEMA)


def stream_table_to_bronze(spark: SparkSession, name: str, table_path: str, audit_path: str, checkpoint: str | None = None,
                           max_files_per_trigger: int | None = None) -> None:
    """Append what the stage table of that name gained since the last call, batch by batch, with an audit row each (S8, SK4)."""
    checkpoint = checkpoint or checkpoint_for(table_path, "by-name")
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    rows = reader.table(name).select(*BRONZE_SCHEMA.fieldNames())
    query = (rows.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
             .foreachBatch(lambda df, batch_id: audited_append(df, table_path, audit_path, checkpoint, batch_id)).start())
    query.awaitTermination()
