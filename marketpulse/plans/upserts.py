"""The gold Type-1 upsert (M1, M2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from marketpulse.operators.upsert import CHANGE_COL
from marketpulse.plans.tables import merge_into
from marketpulse.schemas import GOLD_COLUMNS, GOLD_KEYS, GOLD_MEASURES, GOLD_PARTITION, GOLD_SCHEMA


def merge_gold(spark: SparkSession, path: str, source: DataFrame, null_safe: bool = False,
               record_change: bool = False) -> dict[str, int]:
    """Upsert bars into the gold table at ``path``: match on (Date, Ticker); the sector is never updated.

    Only the dates of ``source`` are rewritten; returns the row counts.
    ``record_change`` keeps what happened to each row in column ``_change``.
    """
    schema = StructType([*GOLD_SCHEMA.fields, StructField(CHANGE_COL, StringType())]) if record_change else GOLD_SCHEMA
    return merge_into(spark, path, schema, source, GOLD_KEYS, GOLD_MEASURES, GOLD_COLUMNS, "Date", GOLD_PARTITION,
                      null_safe)
