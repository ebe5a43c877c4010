"""Bronze loads: bulk (overwrite) and incremental (append from a high-water mark).

posts (landed pages, flattened) -> broadcast join to the company dimension ->
load columns -> noise filter (+ weekday filter for incremental loads) ->
date-partitioned Parquet. The driver only ever holds the plan and one scalar
(the high-water mark).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketpulse.functions.columns import is_weekday, partition_date, without_phrase
from marketpulse.operators.aggregates import high_water_mark_value
from marketpulse.operators.tagging import tag_company
from marketpulse.plans.tables import free_load_id, path_exists, read_loads, replace_loads, write_load
from marketpulse.schemas import BRONZE_PARTITION, BRONZE_SCHEMA
from marketpulse.sources.company import NOISE_PHRASE

TS = "Twitter_Created_datetime"


def _run_date(run_date):
    return F.current_date() if run_date is None else F.lit(str(run_date)).cast("date")


def ntz_literal(value):
    """A Python datetime as a TIMESTAMP_NTZ literal (no local-zone conversion)."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def bronze_frame(posts: DataFrame, dim: DataFrame, run_date=None, *,
                 noise_phrase: str | None = NOISE_PHRASE, weekday_only: bool = False,
                 blank_id: bool = False) -> DataFrame:
    """Bronze rows from flattened posts (``user, created_at, id, text, ticker``).

    ``blank_id`` reproduces the original loads that blanked the id column
    (off by default: the id is the de-duplication key of the stream path).
    """
    tagged = tag_company(posts, dim)
    out = tagged.select(
        F.col("user").cast("string").alias("user"),
        F.col("created_at").alias(TS),
        (F.lit(None).cast("string") if blank_id else F.col("id").cast("string")).alias("id"),
        F.col("text").cast("string").alias("text"),
        F.col("ticker").alias("Ticker"),
        "company", "CompanySector",
        _run_date(run_date).alias("load_date"),
        partition_date("created_at").alias(BRONZE_PARTITION),
    )
    if noise_phrase is not None:
        out = out.where(without_phrase("text", noise_phrase))
    if weekday_only:
        out = out.where(is_weekday(BRONZE_PARTITION))
    return out


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return read_loads(spark, path, BRONZE_SCHEMA)


def bulk_load(posts: DataFrame, dim: DataFrame, path: str, run_date=None, **opts) -> DataFrame:
    """Full reload: replace the bronze table (SK1). Returns the frame written."""
    frame = bronze_frame(posts, dim, run_date, **opts)
    replace_loads(frame, path, "bulk", BRONZE_PARTITION)
    return frame


def incremental_load(posts: DataFrame, dim: DataFrame, path: str, run_date=None, *,
                     per_ticker: bool = False, dedupe: bool = False, load_id: str | None = None,
                     **opts) -> DataFrame:
    """Append posts at or after the table's high-water mark (A2, F5, F2, SK2).

    The mark is read from the data (the newest date's rows). The bound is
    inclusive, like a source ``start_time``; posts exactly on the mark are
    appended again unless ``dedupe`` anti-joins them against the partitions at
    or after the mark. ``per_ticker`` takes one mark per ticker instead of the
    global one (a company fetched early is not cut off by the newest post of a
    company fetched later).

    The load's folder is named after the global mark it starts from, or
    ``load_id``. An attempt that failed left nothing visible and is replaced by
    the next from the same mark. A visible load is never replaced, though the
    mark may not have moved (``per_ticker``, or posts exactly on it): the next
    gets a number. Only a ``load_id`` given again replaces its load; then the
    marks per ticker and ``dedupe`` look at the other loads alone.
    """
    spark = posts.sparkSession
    opts.setdefault("weekday_only", True)
    if not path_exists(spark, path):  # no table yet: everything is new
        frame = bronze_frame(posts, dim, run_date, **opts)
        write_load(frame, path, load_id or "from-start", BRONZE_PARTITION)
        return frame
    bronze = read_bronze(spark, path)
    others = read_loads(spark, path, BRONZE_SCHEMA, without=load_id)
    if per_ticker:
        marks = others.groupBy(F.col("Ticker").alias("_hwm_key")).agg(F.max(TS).alias("_hwm"))
        lowest = marks.agg(F.min("_hwm")).first()[0] if dedupe else None
        new = (posts.join(marks, posts["ticker"] == F.col("_hwm_key"), "left")
               .where(F.col("_hwm").isNull() | (F.col("created_at") >= F.col("_hwm")))
               .drop("_hwm_key", "_hwm"))
        hwm = high_water_mark_value(bronze, TS, partition_col=BRONZE_PARTITION)
    else:
        hwm = lowest = high_water_mark_value(bronze, TS, partition_col=BRONZE_PARTITION)
        new = posts if hwm is None else posts.where(F.col("created_at") >= ntz_literal(hwm))
    frame = bronze_frame(new, dim, run_date, **opts)
    if dedupe and lowest is not None:
        recent = others.where(F.col(BRONZE_PARTITION) >= F.lit(lowest.date())).select("id", "Ticker")
        frame = frame.join(recent, ["id", "Ticker"], "left_anti")
    start = "start" if hwm is None else hwm.strftime("%Y%m%dT%H%M%S%f")
    load_id = load_id or free_load_id(spark, path, BRONZE_SCHEMA, f"from-{start}{'-per-ticker' * per_ticker}")
    write_load(frame, path, load_id, BRONZE_PARTITION)
    return frame
