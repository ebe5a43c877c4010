"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketpulse.session import ensure_checkpoint_dir, scratch_path

# ASCII white space, and a word as the contracts define them
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def held_out(id_col: str, mod: int, remainder: int) -> Column:
    """True for rows whose crc32 of the id's text leaves ``remainder``; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % mod == remainder


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage there.

    A reliable checkpoint: the files outlive the executors that wrote them.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: its plan runs once, and later reads take only the columns they need."""
    spark, folder = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def exchange_size(total: int, least: int, factor: int) -> int:
    """Size of blocks and key ranges for ``total`` bytes that blocks send pieces of to ranges.

    A block sends one row per range. The product of both sizes grows with the
    total, so that such a row keeps some dozens of entries at any scale.
    """
    return max(least, int((factor * total) ** 0.5))


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, a job's shuffle files go as soon as the job has ended.

    Else they stay until the driver happens to collect its garbage, and the
    disk holds those of several jobs. For eager jobs whose result is written.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def arrow_batches(spark: SparkSession, most: int) -> Iterator[None]:
    """Within it, a batch to Python ends with the row that fills ``most`` bytes. For eager jobs on wide rows."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def write_wide(df: DataFrame, folder: str, row_group: int = 16 << 20) -> None:
    """Parquet of rows of some MB each: small row groups, so that neither writer nor reader holds many rows."""
    (df.write.option("parquet.block.size", row_group).option("parquet.block.size.row.check.min", 1)
     .option("parquet.page.size.row.check.min", 1).parquet(folder))
