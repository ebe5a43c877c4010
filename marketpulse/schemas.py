"""Declared schemas per layer; nothing is inferred.

Event times are UTC wall-clock ``TIMESTAMP_NTZ`` in every layer after the raw
page (whose ``created_at`` is an ISO-8601 string with a zone).
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, DateType, DoubleType, LongType, StringType, StructField, StructType,
    TimestampNTZType,
)

# One landed API page: ``data`` is absent when nothing matched, ``next_token``
# is absent on the last page of a search.
POST_FIELDS = StructType([
    StructField("author_id", StringType()),
    StructField("created_at", StringType()),
    StructField("id", StringType()),
    StructField("source", StringType()),
    StructField("text", StringType()),
])

PAGE_SCHEMA = StructType([
    StructField("data", ArrayType(POST_FIELDS)),
    StructField("meta", StructType([
        StructField("result_count", LongType()),
        StructField("next_token", StringType()),
    ])),
])

# Landing layout: <root>/ticker=<T>/page=<n>/<file>.json ; the partition
# columns carry the search key and the page sequence number. ``token`` is the
# token the page was requested with (absent for a first page).
LANDED_PAGE_SCHEMA = StructType(PAGE_SCHEMA.fields + [
    StructField("token", StringType()),
    StructField("run", StringType()),
    StructField("ticker", StringType()),
    StructField("page", LongType()),
])

# Flattened post, tagged with its search key.
RAW_POST_SCHEMA = StructType([
    StructField("user", StringType()),
    StructField("created_at", TimestampNTZType()),
    StructField("id", StringType()),
    StructField("text", StringType()),
    StructField("ticker", StringType()),
])

COMPANY_SCHEMA = StructType([
    StructField("ordinal", LongType(), False),
    StructField("ticker", StringType(), False),
    StructField("keyword", StringType(), False),
    StructField("sector", StringType()),
])

BRONZE_SCHEMA = StructType([
    StructField("user", StringType()),
    StructField("Twitter_Created_datetime", TimestampNTZType()),
    StructField("id", StringType()),
    StructField("text", StringType()),
    StructField("Ticker", StringType()),
    StructField("company", StringType()),
    StructField("CompanySector", StringType()),
    StructField("load_date", DateType()),
    StructField("Tweet_date", DateType()),
])

SILVER_SCHEMA = StructType([
    StructField("Twitter_Created_datetime", TimestampNTZType()),
    StructField("id", StringType()),
    StructField("text", StringType()),
    StructField("Ticker", StringType()),
    StructField("company", StringType()),
    StructField("companySector", StringType()),
    StructField("load_date", DateType()),
    StructField("sentID", DoubleType()),
    StructField("Tweet_date", DateType()),
])

BARS_SCHEMA = StructType([
    StructField("index", LongType()),
    StructField("Date", TimestampNTZType()),
    StructField("Ticker", StringType()),
    StructField("CompanySector", StringType()),
    StructField("Adj_Close", DoubleType()),
    StructField("Close", DoubleType()),
    StructField("High", DoubleType()),
    StructField("Low", DoubleType()),
    StructField("Open", DoubleType()),
    StructField("Volume", LongType()),
])

GOLD_COLUMNS = ["Date", "Ticker", "Adj_Close", "Close", "High", "Low", "Open", "Volume",
                "CompanySector", "sentimentScore"]
GOLD_KEYS = ["Date", "Ticker"]
GOLD_MEASURES = ["Adj_Close", "Close", "High", "Low", "Open", "Volume", "sentimentScore"]

BRONZE_PARTITION = "Tweet_date"
GOLD_PARTITION = "Gold_date"

GOLD_SCHEMA = StructType([next(f for f in [*BARS_SCHEMA.fields, StructField("sentimentScore", DoubleType())] if f.name == c)
                          for c in GOLD_COLUMNS])
