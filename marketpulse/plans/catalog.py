"""Catalog-level sinks and scans (SK1-SK3, SK5, SK6, S7) for name-based tables.

Path-based writes (``plans.tables``) need no catalog; these helpers are for
deployments that address tables by name. Parquet is the table format; after
every write the table's cached file listing is refreshed so the same session
reads what was just written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _quote(name: str) -> str:
    return ".".join(f"`{part.strip('`')}`" for part in name.split("."))


def use_database(spark: SparkSession, name: str) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` + make it current (SK5)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quote(name)}")
    spark.catalog.setCurrentDatabase(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """``DROP TABLE IF EXISTS`` (SK6)."""
    spark.sql(f"DROP TABLE IF EXISTS {_quote(name)}")


def save_table(df: DataFrame, name: str, mode: str = "overwrite",
               partition_col: str | None = None) -> None:
    """Overwrite or append a Parquet catalog table, optionally date-partitioned (SK1-SK3)."""
    spark = df.sparkSession
    writer_df = df.hint("rebalance", partition_col) if partition_col else df
    writer = writer_df.write.format("parquet").mode(mode)
    if partition_col:
        writer = writer.partitionBy(partition_col)
    writer.saveAsTable(name)
    spark.catalog.refreshTable(name)


def save_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int) -> None:
    """Overwrite a Parquet catalog table bucketed and sorted by ``keys``.

    A join or aggregation on these keys reads it without moving it; the other side of a
    join is moved into the same buckets. ``buckets`` fixes the tasks of such a join: about the table's
    size over 128 MB. Each key's rows lie in one bucket, so the keys should be near unique.
    """
    df.repartition(buckets, *keys).write.format("parquet").mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    df.sparkSession.catalog.refreshTable(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Full table scan by name (S7); filters and projections still push down."""
    return spark.table(name)


def register_path(spark: SparkSession, name: str, path: str) -> None:
    """Expose a path-based Parquet table (e.g. bronze) under a catalog name."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_quote(name)} USING parquet LOCATION '{path}'")
    if _is_partitioned(spark, name):
        spark.sql(f"ALTER TABLE {_quote(name)} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)


def _is_partitioned(spark: SparkSession, name: str) -> bool:
    return any(c.isPartition for c in spark.catalog.listColumns(name))
