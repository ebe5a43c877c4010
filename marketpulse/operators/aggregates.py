"""Aggregations: hourly mean (A1), counts (A3), load audit (A4), high-water mark (A2).

All are hash aggregates with a partial (map-side) step, so a hot key (one
ticker holding a third of the rows) costs one partial row per task, not a
skewed shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketpulse.functions.columns import iso_z, nan_to_null
from marketpulse.operators.page_chain import chain_status


def hourly_mean(bucketed: DataFrame, keys=("Ticker", "companySector", "enddatetime"),
                value_col: str = "sentID", out_col: str = "sentimentScore") -> DataFrame:
    """Mean score per (ticker, sector, bucket end).

    Like the original frame group-by: rows with a missing key are dropped,
    missing scores (NULL or NaN) are skipped; a group of only missing scores
    gives NULL.
    """
    keys = list(keys)
    return (bucketed.na.drop(subset=keys)
            .groupBy(*keys)
            .agg(F.avg(nan_to_null(value_col)).alias(out_col)))


def company_counts(posts: DataFrame, key_col: str = "ticker", out_col: str = "n_posts") -> DataFrame:
    """Posts per search key; NULL keys are not counted (frame semantics)."""
    return posts.where(F.col(key_col).isNotNull()).groupBy(key_col).agg(F.count(F.lit(1)).alias(out_col))


def load_audit(pages: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """One audit row per load run and search key: ``run, [ordinal,] ticker, post_count, ...``.

    ``pages`` has ``run, ticker, page, token, meta`` (the landed page documents).
    ``post_count`` and ``total_posts`` are both the sum of ``result_count`` over
    non-empty pages (they are always equal, as in the original audit list);
    ``complete`` says whether the search's chain of pages is unbroken from the first
    page to one without ``next_token`` (see :mod:`~marketpulse.operators.page_chain`).
    """
    rc = F.col("meta.result_count")
    nonempty = rc.isNotNull() & (rc > 0)
    audit = pages.groupBy("run", "ticker").agg(
        F.coalesce(F.sum(F.when(nonempty, rc)), F.lit(0)).alias("post_count"),
        F.coalesce(F.sum(F.when(nonempty, rc)), F.lit(0)).alias("total_posts"),
        F.count(F.lit(1)).alias("pages"),
    )
    chain = chain_status(pages).select(F.col("run").alias("_mp_run"), F.col("ticker").alias("_mp_ticker"), "complete")
    same = F.col("run").eqNullSafe(F.col("_mp_run")) & F.col("ticker").eqNullSafe(F.col("_mp_ticker"))
    audit = audit.join(chain, same).drop("_mp_run", "_mp_ticker")
    if dim is not None:
        audit = audit.join(dim.select("ordinal", "ticker"), "ticker", "left")
    return audit


def high_water_mark(df: DataFrame, ts_col: str, by: str | None = None) -> DataFrame:
    """``max(ts)`` (globally or per key) plus its ``isoformat()+'Z'`` text."""
    grouped = df.groupBy(by) if by else df.groupBy()
    return (grouped.agg(F.max(ts_col).alias("hwm"))
            .withColumn("hwm_iso", F.when(F.col("hwm").isNotNull(), iso_z("hwm"))))


def high_water_mark_value(df: DataFrame, ts_col: str, partition_col: str | None = None):
    """The global high-water mark as a Python value (S9), or None when empty.

    With ``partition_col`` (a date partition derived monotonically from
    ``ts_col``) the newest partition is found first and only it is scanned
    for the exact maximum, instead of every partition's time column.
    """
    if partition_col:
        newest = df.agg(F.max(partition_col)).first()[0]
        if newest is None:
            return None
        df = df.where(F.col(partition_col) == F.lit(newest))
    return df.agg(F.max(ts_col)).first()[0]
