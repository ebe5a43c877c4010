"""Registered queries over the test tables, each with its DuckDB oracle SQL.

Every query reads whole tables (``events`` as the post stream, ``orders``,
``documents``) or data Spark derives from them; none uses id subsets, row
caps or samples. Limits appear only where they are the feature (latest posts,
the ten-row gold preview). Queries that exercise a sink write to a fresh
folder under the shared checkpoint dir and read the result back.

The oracle SQL is rendered from the same fixed values (dictionaries, grid,
parameters) but expresses the semantics independently in plain SQL
(theta joins, window sums, full outer joins).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marketpulse.functions.columns import is_weekday, iso_z, nan_to_null, start_of_day, without_phrase
from marketpulse.operators.aggregates import company_counts, high_water_mark, load_audit
from marketpulse.operators.interval_join import interval_join
from marketpulse.operators.keyword import match_keywords
from marketpulse.operators.keyword_index import add_texts, read_index, search_index
from marketpulse.operators.page_cap import cap_pages
from marketpulse.operators.page_chain import chain_status
from marketpulse.operators.tagging import tag_company, with_sector_case
from marketpulse.operators.timegrid import HourGrid, bucket_assign, span_grid
from marketpulse.operators.upsert import upsert_type1
from marketpulse.plans.bronze import bronze_frame, bulk_load, incremental_load, read_bronze
from marketpulse.plans.catalog import drop_table, read_table, save_bucketed, save_table, use_database
from marketpulse.plans.gold import (
    build_gold, correction_rows, hourly_sentiment, join_scores, read_gold, scored_gold, write_gold,
)
from marketpulse.plans.hourly import add_load, correction, hourly_means, partials, refresh_gold
from marketpulse.plans.silver import build_silver, read_silver, write_silver
from marketpulse.plans.upserts import merge_gold
from marketpulse.schemas import BRONZE_PARTITION, GOLD_COLUMNS, GOLD_KEYS, GOLD_MEASURES
from marketpulse.session import scratch_path
from marketpulse.sources.company import (
    COMPANIES, EARLY_COMPANY_COUNT, NOISE_PHRASE, PAGE_CAP, SECTOR_CASE_ARMS, SECTOR_CASE_DEFAULT,
    company_dim,
)
from marketpulse.sources.literal import literal_frame
from marketpulse.sources.pages import flatten_pages, land_pages, read_pages
from marketpulse.sources.testdata import (
    EVENT_PAGE_WIDTH, EVENT_TICKERS, bars_from_events, posts_from_events, scored_from_posts, scored_posts, table,
)
from marketpulse.streaming.bronze_stream import (
    append_batch, checkpoint_for, read_audit, stage_posts, stream_table_to_bronze, stream_to_bronze,
)
from marketpulse.streaming.polling import poll, stream_new_posts

# --- Test parameters (the original's literals moved onto the test month) ----
RUN_DATE = "2024-02-01"
TEST_GRID = HourGrid.from_range("2024-01-02 01:30:00", "2024-01-30 00:00:00")  # 671 buckets
INCREMENTAL_CUT = "2024-01-20 00:00:00"
AS_OF = "2024-01-29 15:00:00"
CORRECTION_TICKER = "CAT"
CORRECTION_UNTIL = "2024-01-08 14:30:00"
DOC_NOISE_PHRASE = "Apache License"
DOCUMENT_SEARCHES = [
    ("APACHE", '"Apache License"'),
    ("GPL", '"General Public License"'),
    ("MIT", '"MIT License"'),
    ("WORTHLESS", "worthless"),
    ("DERDIE", "der die"),
    ("DELA", '"de la"'),
]
LATEST_N = 20
GOLD_PREVIEW_N = 10
SCORE_DIGITS = 8  # averages are compared after rounding (summation order differs)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- SQL pieces
def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)


def _case(col: str, arms, default=None) -> str:
    whens = " ".join(f"WHEN {col} = {_lit(k)} THEN {_lit(v)}" for k, v in arms)
    return f"CASE {whens} ELSE {_lit(default)} END"


DIM_CTE = ("dim AS (SELECT CAST(o AS BIGINT) AS ordinal, ticker, keyword, sector FROM (VALUES "
           + _values([(i, t, k, s) for i, (t, k, s) in enumerate(COMPANIES)])
           + ") v(o, ticker, keyword, sector))")
EARLY_DIM_CTE = ("early_dim AS (SELECT ticker, keyword FROM (VALUES "
                 + _values([(t, k) for t, k, _ in COMPANIES[:EARLY_COMPANY_COUNT]])
                 + ") v(ticker, keyword))")
POSTS_SELECT = f"""
  SELECT CAST(user_id AS VARCHAR) AS "user", ts AS created_at, CAST(event_id AS VARCHAR) AS id,
         props AS text, {_case('event_type', EVENT_TICKERS)} AS ticker, value AS sentID,
         event_id // {EVENT_PAGE_WIDTH} AS page, event_id
  FROM events"""
POSTS_CTE = f"posts AS ({POSTS_SELECT})"
TAGGED_CTE = """tagged AS (
  SELECT p.*, d.keyword AS company, d.sector AS CompanySector
  FROM posts p JOIN dim d ON p.ticker = d.ticker)"""
BASE = f"WITH {DIM_CTE},\n{POSTS_CTE},\n{TAGGED_CTE}"
# posts that the events lack: on grid points, around the grid's ends, without time,
# text, score or key, on a weekend, with the excluded phrase
EDGE_POSTS = [
    ("-1", "2024-01-02 01:30:00", "first grid point", "CAT", "1.5"),
    ("-2", "2024-01-03 10:30:00", "inner grid point: two buckets", "CAT", "-0.5"),
    ("-3", "2024-01-30 00:30:00", "end of the last bucket", "CAT", "0.25"),
    ("-4", "2024-01-30 00:30:01", "one second later", "CAT", "9"),
    ("-5", None, "no time", "CAT", "9"),
    ("-6", "2024-01-03 10:45:00", None, "CAT", "9"),
    ("-7", "2024-01-04 12:30:00", "no score", "BAC", None),
    ("-8", "2024-01-04 12:31:00", "score not a number", "BAC", "NaN"),
    ("-9", "2024-01-06 12:00:00", "Saturday", "BAC", "1"),
    ("-10", "2024-01-07 12:00:00", "Sunday", "BAC", "1"),
    ("-11", "2024-01-08 12:00:00", "a game at Bank of America Stadium tonight", "BAC", "1"),
    ("-12", "2024-01-08 12:00:00", "a game at bank of america stadium tonight", "BAC", "1"),
    ("-13", "2024-01-08 12:00:00", "no key", None, "1"),
    ("-14", "1969-12-31 23:30:00", "long ago, the only post of its hour", "DVN", None),
]
EDGE_BASE = BASE.replace(POSTS_SELECT, f"""{POSTS_SELECT}
  UNION ALL SELECT 'edge', CAST(c1 AS TIMESTAMP), c0, c2, c3, CAST(c4 AS DOUBLE), 0, CAST(c0 AS BIGINT)
  FROM (VALUES {_values(EDGE_POSTS)}) e(c0, c1, c2, c3, c4)""")


def _bronze_select(where: str) -> str:
    return f"""SELECT "user", created_at AS Twitter_Created_datetime, id, text, ticker AS Ticker,
       company, CompanySector, CAST(DATE '{RUN_DATE}' AS TIMESTAMP) AS load_date,
       CAST(CAST(created_at AS DATE) AS TIMESTAMP) AS Tweet_date
FROM tagged WHERE NOT contains(text, {_lit(NOISE_PHRASE)}) AND ({where})"""


GRID_CTE = f"""grid AS (
  SELECT s AS startdatetime, s + INTERVAL 1 HOUR AS enddatetime
  FROM (SELECT unnest(generate_series(TIMESTAMP '{TEST_GRID.first_start}',
        TIMESTAMP '{TEST_GRID.first_start + TEST_GRID.width * (TEST_GRID.count - 1)}',
        INTERVAL 1 HOUR)) AS s))"""
SILVER_CTE = """silver AS (
  SELECT * FROM tagged WHERE isodow(CAST(created_at AS DATE)) <= 5)"""
HOURLY_CTE = """hourly AS (
  SELECT s.ticker AS Ticker, s.CompanySector AS companySector, g.enddatetime,
         avg(CASE WHEN isnan(s.sentID) THEN NULL ELSE s.sentID END) AS sentimentScore
  FROM silver s JOIN grid g ON s.created_at >= g.startdatetime AND s.created_at <= g.enddatetime
  WHERE s.ticker IS NOT NULL AND s.CompanySector IS NOT NULL
  GROUP BY ALL)"""
BARS_CTE = """bars AS (
  SELECT date_diff('hour', TIMESTAMP '1970-01-01 00:00:00', "Date") AS "index", "Date",
         ticker AS Ticker, CompanySector, "Close" AS Adj_Close, "Close", High, Low, "Open", Volume
  FROM (SELECT ticker, CompanySector,
               date_trunc('hour', created_at - INTERVAL 30 MINUTE) + INTERVAL 90 MINUTE AS "Date",
               first(sentID ORDER BY created_at, event_id) AS "Open", max(sentID) AS High, min(sentID) AS Low,
               last(sentID ORDER BY created_at, event_id) AS "Close", count(*) AS Volume
        FROM tagged GROUP BY ALL))"""
GOLD_CTE = """gold AS (
  SELECT b."Date", b.Ticker, b.Adj_Close, b."Close", b.High, b.Low, b."Open", b.Volume,
         b.CompanySector, h.sentimentScore
  FROM bars b LEFT JOIN hourly h
    ON b."Date" = h.enddatetime AND b.Ticker = h.Ticker AND b.CompanySector = h.companySector)"""
GOLD_BASE = f"{BASE},\n{GRID_CTE},\n{SILVER_CTE},\n{HOURLY_CTE},\n{BARS_CTE},\n{GOLD_CTE}"
CORRECTION_CTE = f"""src AS (
  SELECT "Date" - INTERVAL 24 HOUR AS "Date", Ticker, Adj_Close, "Close", High, Low, "Open", Volume,
         CompanySector, sentimentScore
  FROM gold WHERE sentimentScore IS NULL AND Ticker = {_lit(CORRECTION_TICKER)}
    AND "Date" <= TIMESTAMP '{CORRECTION_UNTIL}')"""
_MEASURES = ["Adj_Close", "Close", "High", "Low", "Open", "Volume", "sentimentScore"]
MERGE_CTE = """merged AS (
  SELECT CASE WHEN NOT has_t THEN s_Date ELSE "Date" END AS "Date",
         CASE WHEN NOT has_t THEN s_Ticker ELSE Ticker END AS Ticker,
         """ + ",\n         ".join(
    f'CASE WHEN NOT has_t OR upd THEN s_{c} ELSE "{c}" END AS "{c}"' for c in _MEASURES) + """,
         CASE WHEN NOT has_t THEN s_CompanySector ELSE CompanySector END AS CompanySector,
         CASE WHEN NOT has_t THEN 'insert' WHEN upd THEN 'update' ELSE 'copy' END AS _change
  FROM (SELECT *, coalesce(_t, FALSE) AS has_t,
               coalesce(_t AND _s AND (""" + " OR ".join(f'"{c}" <> s_{c}' for c in _MEASURES) + """), FALSE) AS upd
        FROM (SELECT t.*, TRUE AS _t FROM gold t) tt
        FULL OUTER JOIN (SELECT """ + ", ".join(
    f'"{c}" AS s_{c}' for c in ["Date", "Ticker", "CompanySector"] + _MEASURES) + """, TRUE AS _s FROM src) ss
          ON tt."Date" = ss.s_Date AND tt.Ticker = ss.s_Ticker))"""


def _round_score(df: DataFrame) -> DataFrame:
    return df.withColumn("sentimentScore", F.round("sentimentScore", SCORE_DIGITS))


GOLD_SELECT = ", ".join(f'"{c}"' if c != "sentimentScore" else f"round(sentimentScore, {SCORE_DIGITS}) AS sentimentScore"
                        for c in GOLD_COLUMNS)


# ----------------------------------------------------------------- helpers
def _events(spark, sf_dir):
    return table(spark, sf_dir, "events")


def _posts(spark, sf_dir):
    return posts_from_events(_events(spark, sf_dir))


def _edge_posts(spark, sf_dir):
    """The posts of the events and the edge posts."""
    schema = StructType([StructField(c, StringType()) for c in ("id", "t", "text", "ticker", "s")])
    edges = literal_frame(spark, EDGE_POSTS, schema).select(
        F.lit("edge").alias("user"), F.col("t").cast("timestamp_ntz").alias("created_at"), "id", "text", "ticker",
        F.col("s").cast("double").alias("sentID"), F.lit(0).cast("bigint").alias("page"))
    return _posts(spark, sf_dir).unionByName(edges)


def _dim(spark):
    return company_dim(spark)


def _silver(spark, sf_dir):
    return build_silver(scored_posts(_events(spark, sf_dir), _dim(spark), RUN_DATE))


def _gold(spark, sf_dir, sort=True):
    dim = _dim(spark)
    bars = bars_from_events(_events(spark, sf_dir), dim)
    return build_gold(bars, _silver(spark, sf_dir), TEST_GRID, sort=sort)


def _landed_pages(spark, sf_dir, name) -> str:
    root = scratch_path(spark, name)
    land_pages(_posts(spark, sf_dir), root)
    return root


def _ntz(s: str):
    return F.lit(s).cast("timestamp_ntz")


def _dates_as_timestamps(df: DataFrame) -> DataFrame:
    """Present DATE columns as midnight TIMESTAMP_NTZ (the tables keep DATE).

    Results are compared with the oracle's; timestamps convert identically on
    both sides, dates do not (date objects vs timestamps in pandas).
    """
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if t == "date" else F.col(c)
                       for c, t in df.dtypes])


# ----------------------------------------------------------------- queries
@register("company_tag", f"""{BASE}
SELECT id, "user", created_at, ticker, company, CompanySector FROM tagged""")
def q_company_tag(spark, sf_dir):
    tagged = tag_company(_posts(spark, sf_dir), _dim(spark))
    return tagged.select("id", "user", "created_at", "ticker", "company", "CompanySector")


@register("sector_case", f"""WITH {POSTS_CTE}
SELECT id, ticker AS key_flag, {_case('ticker', SECTOR_CASE_ARMS, SECTOR_CASE_DEFAULT)} AS sector
FROM posts""")
def q_sector_case(spark, sf_dir):
    posts = _posts(spark, sf_dir).select("id", F.col("ticker").alias("key_flag"))
    return with_sector_case(posts, "key_flag", "sector")


@register("company_counts", f"""WITH {POSTS_CTE}
SELECT ticker, count(*) AS n_posts FROM posts WHERE ticker IS NOT NULL GROUP BY ticker""")
def q_company_counts(spark, sf_dir):
    return company_counts(_posts(spark, sf_dir), "ticker", "n_posts")


@register("weekday_filter", """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE isodow(o_orderdate) <= 5""")
def q_weekday_filter(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.where(is_weekday("o_orderdate")).select("o_orderkey", "o_orderdate", "o_totalprice")


@register("noise_filter", f"""SELECT doc_id, lang, source, n_chars FROM documents
WHERE NOT contains(text, {_lit(DOC_NOISE_PHRASE)})""")
def q_noise_filter(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.where(without_phrase("text", DOC_NOISE_PHRASE)).select("doc_id", "lang", "source", "n_chars")


_ISO_SQL = ("strftime(hwm, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(hwm) % 1000000 = 0 THEN '' "
            "ELSE '.' || lpad(CAST(microsecond(hwm) % 1000000 AS VARCHAR), 6, '0') END || 'Z'")


@register("high_water_mark", f"""SELECT hwm, {_ISO_SQL} AS hwm_iso
FROM (SELECT max(ts) AS hwm FROM events)""")
def q_high_water_mark(spark, sf_dir):
    return high_water_mark(_posts(spark, sf_dir), "created_at")


@register("hwm_per_ticker", f"""WITH {POSTS_CTE}
SELECT ticker, hwm, {_ISO_SQL} AS hwm_iso FROM (SELECT ticker, max(created_at) AS hwm FROM posts GROUP BY ticker)""")
def q_hwm_per_ticker(spark, sf_dir):
    return high_water_mark(_posts(spark, sf_dir), "created_at", by="ticker")


@register("since_midnight", f"""WITH {POSTS_CTE}
SELECT id, ticker, created_at, '{AS_OF[:10]}T00:00:00Z' AS start_time FROM posts
WHERE created_at >= date_trunc('day', TIMESTAMP '{AS_OF}') AND created_at <= TIMESTAMP '{AS_OF}'""")
def q_since_midnight(spark, sf_dir):
    as_of = _ntz(AS_OF)
    start = start_of_day(as_of)
    posts = _posts(spark, sf_dir)
    return (posts.where((F.col("created_at") >= start) & (F.col("created_at") <= as_of))
            .select("id", "ticker", "created_at", iso_z(start).alias("start_time")))


@register("latest_posts", f"""WITH {POSTS_CTE}
SELECT id, ticker, created_at FROM posts ORDER BY created_at DESC, id DESC LIMIT {LATEST_N}""")
def q_latest_posts(spark, sf_dir):
    return (_posts(spark, sf_dir).select("id", "ticker", "created_at")
            .orderBy(F.col("created_at").desc(), F.col("id").desc()).limit(LATEST_N))


@register("union_loads", f"""{BASE},
{EARLY_DIM_CTE}
SELECT id, created_at, ticker, company, CompanySector FROM tagged
WHERE created_at < TIMESTAMP '{INCREMENTAL_CUT}'
UNION ALL
SELECT p.id, p.created_at, p.ticker, e.keyword AS company, NULL AS CompanySector
FROM posts p JOIN early_dim e ON p.ticker = e.ticker
WHERE p.created_at >= TIMESTAMP '{INCREMENTAL_CUT}'""")
def q_union_loads(spark, sf_dir):
    """A load with sectors, and one of the earlier variant (20 companies, so IVV drops out; no sector)."""
    posts = _posts(spark, sf_dir)
    cut = _ntz(INCREMENTAL_CUT)
    with_sector = (tag_company(posts.where(F.col("created_at") < cut), _dim(spark))
                   .select("CompanySector", "company", "ticker", "created_at", "id"))
    early = company_dim(spark, [(t, k) for t, k, _ in COMPANIES[:EARLY_COMPANY_COUNT]])
    without_sector = (tag_company(posts.where(F.col("created_at") >= cut), early)
                      .select("id", "created_at", "ticker", "company"))
    return with_sector.unionByName(without_sector, allowMissingColumns=True)


@register("silver_cast", f"""{BASE}
SELECT created_at AS Twitter_Created_datetime, id, text, ticker AS Ticker, company,
       CompanySector AS companySector, CAST(DATE '{RUN_DATE}' AS TIMESTAMP) AS load_date, sentID,
       CAST(CAST(created_at AS DATE) AS TIMESTAMP) AS Tweet_date
FROM tagged WHERE isodow(CAST(created_at AS DATE)) <= 5""")
def q_silver_cast(spark, sf_dir):
    scored = scored_posts(_events(spark, sf_dir), _dim(spark), RUN_DATE)
    as_text = scored.select(*[F.col(c).cast("string").alias(c) if c != "Tweet_date" else F.col(c)
                              for c in scored.columns])
    return _dates_as_timestamps(build_silver(as_text))


@register("time_grid", """SELECT CAST(round((epoch(s) - epoch(lo)) / 3600) AS BIGINT) + 1 AS bucket,
       s AS startdatetime, s + INTERVAL 1 HOUR AS enddatetime
FROM (SELECT lo, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS s
      FROM (SELECT date_trunc('hour', min(ts)) + INTERVAL 30 MINUTE AS lo,
                   date_trunc('hour', max(ts)) + INTERVAL 30 MINUTE AS hi FROM events))""")
def q_time_grid(spark, sf_dir):
    grid = span_grid(_posts(spark, sf_dir), "created_at")
    return grid.withColumn("bucket", F.col("bucket").cast("bigint"))


@register("bucket_join", f"""WITH {POSTS_CTE},
{GRID_CTE}
SELECT p.id, p.created_at, g.startdatetime, g.enddatetime
FROM posts p JOIN grid g ON p.created_at >= g.startdatetime AND p.created_at <= g.enddatetime""")
def q_bucket_join(spark, sf_dir):
    posts = _posts(spark, sf_dir).select("id", "created_at")
    return bucket_assign(posts, "created_at", TEST_GRID)


@register("bucket_join_edges", f"""{EDGE_BASE},
{GRID_CTE}
SELECT p.id, p.created_at, g.startdatetime, g.enddatetime
FROM posts p JOIN grid g ON p.created_at >= g.startdatetime AND p.created_at <= g.enddatetime""")
def q_bucket_join_edges(spark, sf_dir):
    """Posts on grid points: in both buckets that touch there."""
    return bucket_assign(_edge_posts(spark, sf_dir).select("id", "created_at"), "created_at", TEST_GRID)


# Campaigns: every order is a stretch of the test month of its own place and length
# (some empty, some long), some of them without a start or an end.
_CAMPAIGN_START = "2024-01-01 00:00:00"


@register("interval_join", f"""WITH c AS (
  SELECT o_orderkey, TIMESTAMP '{_CAMPAIGN_START}' + INTERVAL 1 SECOND * CAST(
           date_diff('day', TIMESTAMP '1995-01-01', o_orderdate) * 1080 + o_custkey % 1080 AS INTEGER) AS a,
         CAST(CASE WHEN o_custkey % 500 = 7 THEN 864000 ELSE floor(o_totalprice / 500) - 100 END AS INTEGER) AS seconds
  FROM orders),
campaigns AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 5000 <> 2499 THEN a END AS started,
         CASE WHEN o_orderkey % 5000 <> 4999 THEN a + INTERVAL 1 SECOND * seconds END AS ended FROM c)
SELECT event_id, ts, o_orderkey, started, ended
FROM events JOIN campaigns ON ts >= coalesce(started, '-infinity'::TIMESTAMP) AND ts <= coalesce(ended, 'infinity'::TIMESTAMP)""")
def q_interval_join(spark, sf_dir):
    """Events in irregular, overlapping, empty and open-ended stretches, one per order."""
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date")).cast("bigint")
    seconds = F.when(F.col("o_custkey") % 500 == 7, F.lit(864000)).otherwise(F.floor(F.col("o_totalprice") / 500) - 100)

    def later(c, n):
        return F.timestamp_add("SECOND", n.cast("bigint"), c)

    key, a = F.col("o_orderkey"), later(_ntz(_CAMPAIGN_START), day * 1080 + F.col("o_custkey") % 1080)
    campaigns = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(key % 5000 != 2499, a).alias("started"),
        F.when(key % 5000 != 4999, later(a, seconds)).alias("ended"))
    events = _events(spark, sf_dir).select("event_id", "ts")
    return interval_join(events, campaigns, "ts", "started", "ended", open_ended=True)


@register("hourly_sentiment_edges", f"""{EDGE_BASE},
{GRID_CTE},
{SILVER_CTE},
{HOURLY_CTE}
SELECT Ticker, companySector, enddatetime, round(sentimentScore, {SCORE_DIGITS}) AS sentimentScore FROM hourly""")
def q_hourly_sentiment_edges(spark, sf_dir):
    """Scores that are NULL or not a number, posts on grid points and weekends."""
    silver = build_silver(scored_from_posts(_edge_posts(spark, sf_dir), _dim(spark), RUN_DATE))
    return _round_score(hourly_sentiment(silver, TEST_GRID))


@register("hourly_sentiment", f"""{BASE},
{GRID_CTE},
{SILVER_CTE},
{HOURLY_CTE}
SELECT Ticker, companySector, enddatetime, round(sentimentScore, {SCORE_DIGITS}) AS sentimentScore FROM hourly""")
def q_hourly_sentiment(spark, sf_dir):
    return _round_score(hourly_sentiment(_silver(spark, sf_dir), TEST_GRID))


@register("gold_build", f"""{GOLD_BASE}
SELECT {GOLD_SELECT} FROM gold""")
def q_gold_build(spark, sf_dir):
    return _round_score(_gold(spark, sf_dir))


@register("gold_nonnull", f"""{GOLD_BASE}
SELECT {GOLD_SELECT} FROM gold WHERE sentimentScore IS NOT NULL
ORDER BY Ticker, "Date" LIMIT {GOLD_PREVIEW_N}""")
def q_gold_nonnull(spark, sf_dir):
    preview = (scored_gold(_gold(spark, sf_dir, sort=False))
               .orderBy(F.col("Ticker").asc_nulls_last(), F.col("Date").asc_nulls_last())
               .limit(GOLD_PREVIEW_N))
    return _round_score(preview)


@register("correction_rows", f"""{GOLD_BASE},
{CORRECTION_CTE}
SELECT {GOLD_SELECT} FROM src""")
def q_correction_rows(spark, sf_dir):
    rows = correction_rows(_gold(spark, sf_dir, sort=False), CORRECTION_TICKER, CORRECTION_UNTIL)
    rows.createOrReplaceTempView("src_table")
    return _round_score(spark.table("src_table"))


def _run_merge(spark, sf_dir, name) -> tuple[str, dict]:
    """Gold written, then corrected in place; its path and the merge's row counts."""
    path = scratch_path(spark, name)
    write_gold(_gold(spark, sf_dir, sort=False).withColumn("_change", F.lit("copy")), path)
    src = correction_rows(read_gold(spark, path), CORRECTION_TICKER, CORRECTION_UNTIL)
    return path, merge_gold(spark, path, src, record_change=True)


@register("upsert_type1", f"""{GOLD_BASE},
{CORRECTION_CTE},
{MERGE_CTE}
SELECT {GOLD_SELECT}, _change FROM merged""")
def q_upsert_type1(spark, sf_dir):
    path, _ = _run_merge(spark, sf_dir, "gold_upsert")
    return _round_score(spark.read.parquet(path).select(*GOLD_COLUMNS, "_change"))


@register("upsert_history", f"""{GOLD_BASE},
{CORRECTION_CTE},
{MERGE_CTE}
SELECT CAST(0 AS BIGINT) AS version, 'WRITE' AS operation, count(*) AS num_source_rows,
       count(*) AS num_output_rows, count(*) AS num_inserted, CAST(0 AS BIGINT) AS num_updated,
       CAST(0 AS BIGINT) AS num_copied FROM gold
UNION ALL
SELECT CAST(1 AS BIGINT), 'MERGE', (SELECT count(*) FROM src), count(*),
       count(*) FILTER (WHERE _change = 'insert'), count(*) FILTER (WHERE _change = 'update'),
       count(*) FILTER (WHERE _change = 'copy') FROM merged""")
def q_upsert_history(spark, sf_dir):
    """Row counts of the write and of the merge, aggregated from the table after it."""
    path, counts = _run_merge(spark, sf_dir, "gold_history")
    change = F.col("_change")
    n = spark.read.parquet(path).agg(*[F.count(F.when(change == c, 1)).alias(c) for c in ("insert", "update", "copy")])
    before, zero = F.col("update") + F.col("copy"), F.lit(0).cast("bigint")

    def row(version, operation, *numbers):
        names = ("num_source_rows", "num_output_rows", "num_inserted", "num_updated", "num_copied")
        return n.select(F.lit(version).cast("bigint").alias("version"), F.lit(operation).alias("operation"),
                        *[x.alias(c) for x, c in zip(numbers, names)])

    return (row(0, "WRITE", before, before, before, zero, zero)
            .unionByName(row(1, "MERGE", F.lit(counts["source"]).cast("bigint"), before + F.col("insert"),
                             F.col("insert"), F.col("update"), F.col("copy"))))


@register("upsert_scores", f"""{GOLD_BASE}
SELECT {", ".join(f'"{c}"' for c in GOLD_COLUMNS if c != "sentimentScore")},
       round(CASE WHEN Ticker = {_lit(CORRECTION_TICKER)} THEN coalesce(sentimentScore + 1, sentimentScore)
             ELSE sentimentScore END, {SCORE_DIGITS}) AS sentimentScore,
       CASE WHEN Ticker = {_lit(CORRECTION_TICKER)} AND sentimentScore IS NOT NULL THEN 'update' ELSE 'copy' END AS _change
FROM gold""")
def q_upsert_scores(spark, sf_dir):
    """A source that differs from gold in the score alone."""
    path = scratch_path(spark, "gold_scores")
    write_gold(_gold(spark, sf_dir, sort=False), path)
    gold = read_gold(spark, path)
    src = gold.where(F.col("Ticker") == CORRECTION_TICKER).withColumn("sentimentScore", F.col("sentimentScore") + 1)
    return _round_score(upsert_type1(gold, src, GOLD_KEYS, GOLD_MEASURES, GOLD_COLUMNS))


_ORDER_COLUMNS = ["o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority", "o_orderstatus"]


@register("upsert_orders", """WITH tgt AS (SELECT * FROM orders WHERE o_orderkey % 10 <> 0),
src AS (SELECT CASE WHEN o_orderkey % 70 <> 0 THEN o_orderkey END AS k, o_orderdate AS d,
               CASE o_orderkey % 3 WHEN 0 THEN o_totalprice + 1 WHEN 1 THEN NULL ELSE o_totalprice END AS price,
               CASE WHEN o_orderkey % 7 = 0 THEN 'changed' ELSE o_orderpriority END AS prio, 'X' AS status
        FROM orders WHERE o_orderkey % 10 < 2),
j AS (SELECT *, coalesce(k IS NOT NULL AND o_orderkey IS NOT NULL
                         AND (price <> o_totalprice OR prio <> o_orderpriority), FALSE) AS upd
      FROM tgt FULL OUTER JOIN src ON o_orderkey = k AND o_orderdate = d)
SELECT CASE WHEN o_orderkey IS NULL THEN k ELSE o_orderkey END AS o_orderkey,
       CASE WHEN o_orderkey IS NULL THEN d ELSE o_orderdate END AS o_orderdate,
       CASE WHEN o_orderkey IS NULL OR upd THEN price ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey IS NULL OR upd THEN prio ELSE o_orderpriority END AS o_orderpriority,
       CASE WHEN o_orderkey IS NULL THEN status ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey IS NULL THEN 'insert' WHEN upd THEN 'update' ELSE 'copy' END AS _change
FROM j""")
def q_upsert_orders(spark, sf_dir):
    """Nine tenths of the orders as target; a fifth as source, with changed and NULL measures and NULL keys."""
    orders = table(spark, sf_dir, "orders").select(*_ORDER_COLUMNS)
    k = F.col("o_orderkey")
    price = F.when(k % 3 == 0, F.col("o_totalprice") + 1).when(k % 3 == 2, F.col("o_totalprice"))
    src = orders.where(k % 10 < 2).select(
        F.when(k % 70 != 0, k).alias("o_orderkey"), "o_orderdate", price.alias("o_totalprice"),
        F.when(k % 7 == 0, "changed").otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        F.lit("X").alias("o_orderstatus"))
    return upsert_type1(orders.where(k % 10 != 0), src, ["o_orderkey", "o_orderdate"], ["o_totalprice", "o_orderpriority"])


@register("silver_table", f"""{EDGE_BASE}
SELECT created_at AS Twitter_Created_datetime, id, text, ticker AS Ticker, company, CompanySector AS companySector,
       CAST(DATE '{RUN_DATE}' AS TIMESTAMP) AS load_date, nullif(sentID, 'nan'::DOUBLE) AS sentID,
       CAST(CAST(created_at AS DATE) AS TIMESTAMP) AS Tweet_date
FROM tagged WHERE isodow(CAST(created_at AS DATE)) <= 5""")
def q_silver_table(spark, sf_dir):
    """Silver written by date and read back."""
    path = scratch_path(spark, "silver")
    write_silver(build_silver(scored_from_posts(_edge_posts(spark, sf_dir), _dim(spark), RUN_DATE)), path)
    return _dates_as_timestamps(read_silver(spark, path)).withColumn("sentID", nan_to_null("sentID"))


@register("gold_table", f"""{GOLD_BASE}
SELECT {GOLD_SELECT} FROM gold""")
def q_gold_table(spark, sf_dir):
    """Gold built from a silver table on disk, written and read back."""
    silver, gold = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    write_silver(_silver(spark, sf_dir), silver)
    bars = bars_from_events(_events(spark, sf_dir), _dim(spark))
    write_gold(build_gold(bars, read_silver(spark, silver), TEST_GRID), gold)
    return _round_score(read_gold(spark, gold))


@register("database_tables", f"""{BASE}
{_bronze_select('TRUE')}""")
def q_database_tables(spark, sf_dir):
    """A database; a table saved in it, dropped, created again and read by name."""
    rows, name = bronze_frame(_posts(spark, sf_dir), _dim(spark), RUN_DATE), f"tweet_bronze_{uuid.uuid4().hex[:12]}"
    before = spark.catalog.currentDatabase()
    use_database(spark, "marketpulse_scratch")
    try:
        name = f"marketpulse_scratch.{name}"
        save_table(rows.where(F.col("Ticker") == "CAT"), name, partition_col=BRONZE_PARTITION)
        drop_table(spark, name)
        save_table(rows.where(F.col("Ticker") == "CAT"), name, partition_col=BRONZE_PARTITION)
        save_table(rows.where(F.col("Ticker") != "CAT"), name, mode="append", partition_col=BRONZE_PARTITION)
        copy = scratch_path(spark, "by_name")  # so that no table is left behind
        read_table(spark, name).write.parquet(copy)
    finally:
        spark.catalog.setCurrentDatabase(before)
        drop_table(spark, name)
    return _dates_as_timestamps(spark.read.parquet(copy))


# Three loads by time, posts of every eleventh id late (in the last one); then the scores of
# some CAT posts are corrected: one more, or withdrawn.
LOAD_CUTS = ("2024-01-10 00:00:00", "2024-01-20 12:00:00")
FIXED_FROM, FIXED_TO = "2024-01-05 00:00:00", "2024-01-08 00:00:00"
_FIXED_SQL = f"""ticker = 'CAT' AND event_id % 7 = 0 AND created_at >= TIMESTAMP '{FIXED_FROM}'
                 AND created_at < TIMESTAMP '{FIXED_TO}'"""
FIXED_BASE = GOLD_BASE.replace(SILVER_CTE, f"""silver AS (
  SELECT * REPLACE (CASE WHEN {_FIXED_SQL} THEN CASE WHEN event_id % 2 = 0 THEN NULL ELSE sentID + 1 END
                    ELSE sentID END AS sentID)
  FROM tagged WHERE isodow(CAST(created_at AS DATE)) <= 5)""")


def _hourly_loads(spark, sf_dir):
    """The partial aggregates of three loads and a correction of the silver posts."""
    silver = _silver(spark, sf_dir)
    post, time = F.col("id").cast("bigint"), F.col("Twitter_Created_datetime")
    load = (F.when((time < _ntz(LOAD_CUTS[0])) & (post % 11 != 0), 1)
            .when((time < _ntz(LOAD_CUTS[1])) & (post % 11 != 0), 2).otherwise(3))
    for i in (1, 2, 3):
        yield f"load-{i}", partials(silver.where(load == i), TEST_GRID)
    wrong = silver.where((F.col("Ticker") == "CAT") & (post % 7 == 0) & (time >= _ntz(FIXED_FROM)) & (time < _ntz(FIXED_TO)))
    right = wrong.withColumn("sentID", F.when(post % 2 != 0, F.col("sentID") + 1))
    yield "correction-1", correction(wrong, right, TEST_GRID)


@register("hourly_increments", f"""{FIXED_BASE}
SELECT Ticker, companySector, enddatetime, round(sentimentScore, {SCORE_DIGITS}) AS sentimentScore FROM hourly""")
def q_hourly_increments(spark, sf_dir):
    """The hourly mean after three loads and a correction, none of which rebuilt it."""
    path = scratch_path(spark, "hourly")
    for load_id, rows in _hourly_loads(spark, sf_dir):
        add_load(rows, path, load_id)
    return _round_score(hourly_means(spark, path))


@register("gold_increments", f"""{FIXED_BASE}
SELECT {GOLD_SELECT} FROM gold""")
def q_gold_increments(spark, sf_dir):
    """Gold without scores, then refreshed in the dates of each load and of the correction."""
    path, gold, table_of_bars = (scratch_path(spark, x) for x in ("hourly", "gold_increments", "bars"))
    bars_from_events(_events(spark, sf_dir), _dim(spark)).write.parquet(table_of_bars)
    bars = spark.read.parquet(table_of_bars)
    none = spark.createDataFrame([], "Ticker string, companySector string, enddatetime timestamp_ntz, sentimentScore double")
    write_gold(join_scores(bars, none), gold)
    for load_id, rows in _hourly_loads(spark, sf_dir):
        refresh_gold(spark, bars, path, gold, add_load(rows, path, load_id))
    return _round_score(read_gold(spark, gold))


@register("gold_bucketed", f"""{GOLD_BASE}
SELECT {GOLD_SELECT} FROM gold""")
def q_gold_bucketed(spark, sf_dir):
    """Bars kept as a table bucketed by the join's keys: the left join moves the hourly means alone."""
    name, gold, before = f"marketpulse_scratch.bars_{uuid.uuid4().hex[:12]}", scratch_path(spark, "gold_bucketed"), spark.catalog.currentDatabase()
    use_database(spark, "marketpulse_scratch")
    try:
        save_bucketed(bars_from_events(_events(spark, sf_dir), _dim(spark)), name, ["Date", "Ticker", "CompanySector"], 8)
        write_gold(join_scores(read_table(spark, name), hourly_sentiment(_silver(spark, sf_dir), TEST_GRID)), gold)
    finally:
        spark.catalog.setCurrentDatabase(before)
        drop_table(spark, name)
    return _round_score(read_gold(spark, gold))


@register("json_pages", f"""WITH {POSTS_CTE}
SELECT "user", created_at, id, text, ticker, page FROM posts""")
def q_json_pages(spark, sf_dir):
    root = _landed_pages(spark, sf_dir, "pages_flat")
    return flatten_pages(read_pages(spark, root)).drop("run")


@register("load_audit", f"""WITH {DIM_CTE},
{POSTS_CTE}
SELECT d.ordinal, p.ticker, CAST(count(*) AS BIGINT) AS post_count, CAST(count(*) AS BIGINT) AS total_posts,
       count(DISTINCT p.page) AS pages, TRUE AS complete
FROM posts p LEFT JOIN dim d ON p.ticker = d.ticker GROUP BY d.ordinal, p.ticker""")
def q_load_audit(spark, sf_dir):
    root = _landed_pages(spark, sf_dir, "pages_audit")
    return load_audit(read_pages(spark, root), _dim(spark)).select(
        "ordinal", "ticker", "post_count", "total_posts", "pages", "complete")


def _page_cap_sql(cap: int, runs: str) -> str:
    """Cap over the posts of several runs (a WITH query naming run, ticker, page, id)."""
    return f"""WITH {POSTS_CTE},
loads AS ({runs}),
pc AS (SELECT run, ticker, page, count(*) AS n FROM loads GROUP BY run, ticker, page),
rb AS (SELECT run, ticker, page,
              coalesce(sum(n) OVER (PARTITION BY run, ticker ORDER BY page
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rows_before
       FROM pc)
SELECT p.run, p.id, p.ticker, p.page, CAST(r.rows_before AS BIGINT) AS rows_before
FROM loads p JOIN rb r ON p.run = r.run AND p.ticker IS NOT DISTINCT FROM r.ticker AND p.page = r.page
WHERE r.rows_before < {cap}"""


def _capped_posts(pages: DataFrame, cap: int) -> DataFrame:
    narrow = pages.select("run", "ticker", "page", "data", F.col("meta.result_count").alias("result_count"))
    return (cap_pages(narrow, cap).select("run", "ticker", "page", "rows_before", F.explode("data").alias("p"))
            .select("run", F.col("p.id").alias("id"), "ticker", "page", F.col("rows_before").cast("bigint")))


RAW_PAGES = 20  # source pages in one raw document, so that the fixture is not thousands of tiny files
ONE_RUN = "SELECT 'r1' AS run, * FROM posts"
# a second load of the same keys from the cut on, in which the IVV search lost its key
TWO_RUNS = f"""{ONE_RUN} UNION ALL
  SELECT 'r2' AS run, * REPLACE (nullif(ticker, 'IVV') AS ticker) FROM posts
  WHERE created_at >= TIMESTAMP '{INCREMENTAL_CUT}'"""


def _land_two_runs(spark, sf_dir, name, merge_pages: int = 1, **how) -> str:
    root = scratch_path(spark, name)
    posts = _posts(spark, sf_dir).withColumn("page", F.expr(f"page div {merge_pages}"))
    land_pages(posts, root, run="r1", **how)
    later = posts.where(F.col("created_at") >= _ntz(INCREMENTAL_CUT))
    land_pages(later.withColumn("ticker", F.nullif("ticker", F.lit("IVV"))), root, run="r2", closing_page=True, **how)
    return root


@register("page_cap", _page_cap_sql(PAGE_CAP, ONE_RUN))
def q_page_cap(spark, sf_dir):
    return _capped_posts(read_pages(spark, _landed_pages(spark, sf_dir, "pages_cap")), PAGE_CAP)


for _cap in (PAGE_CAP, 5000):
    @register(f"page_cap_runs_{_cap}", _page_cap_sql(_cap, TWO_RUNS))
    def q_page_cap_runs(spark, sf_dir, cap=_cap):
        """Two runs, a NULL key, empty closing pages; a cap far above the page size too."""
        return _capped_posts(read_pages(spark, _land_two_runs(spark, sf_dir, f"pages_cap_{cap}")), cap)


@register("load_audit_runs", f"""WITH {DIM_CTE},
{POSTS_CTE},
loads AS ({TWO_RUNS})
SELECT p.run, d.ordinal, p.ticker, CAST(count(*) AS BIGINT) AS post_count, CAST(count(*) AS BIGINT) AS total_posts,
       count(DISTINCT p.page) + CASE WHEN p.run = 'r2' AND p.ticker IS DISTINCT FROM 'CAT' THEN 1 ELSE 0 END AS pages,
       NOT (p.run = 'r2' AND p.ticker IS NOT DISTINCT FROM 'CAT') AS complete
FROM loads p LEFT JOIN dim d ON p.ticker = d.ticker GROUP BY p.run, d.ordinal, p.ticker""")
def q_load_audit_runs(spark, sf_dir):
    """Two runs audited apart; the second broke off before CAT's closing page."""
    pages = read_pages(spark, _land_two_runs(spark, sf_dir, "pages_audit_runs"))
    lost = (F.col("run") == "r2") & (F.col("ticker") == "CAT") & F.col("meta.next_token").isNull()
    return load_audit(pages.where(~F.coalesce(lost, F.lit(False))), _dim(spark)).select(
        "run", "ordinal", "ticker", "post_count", "total_posts", "pages", "complete")


# The landed pages of one run, damaged per search: BAC lost a page, CAT's last page points back to its
# fourth, an ENPH page landed twice, a DVN token was answered differently the second time; IVV is whole.
@register("page_chain", f"""WITH RECURSIVE {POSTS_CTE},
n AS (SELECT ticker, page, count(*) AS posts FROM posts GROUP BY ticker, page),
l AS (SELECT ticker, page, posts, row_number() OVER w AS i, count(*) OVER (PARTITION BY ticker) AS pages,
             CASE WHEN row_number() OVER w = 1 THEN '' ELSE ticker || '-' || page END AS tok,
             ticker || '-' || lead(page) OVER w AS next
      FROM n WINDOW w AS (PARTITION BY ticker ORDER BY page)),
p AS (SELECT ticker, page, posts, tok, CASE WHEN ticker = 'CAT' AND i = pages
               THEN (SELECT tok FROM l f WHERE f.ticker = 'CAT' AND f.i = 4) ELSE next END AS next
      FROM l WHERE NOT (ticker = 'BAC' AND i = pages // 2)
      UNION ALL SELECT ticker, page, posts, tok, next FROM l WHERE ticker = 'ENPH' AND i = pages // 3
      UNION ALL SELECT ticker, page, posts, tok, 'elsewhere' FROM l WHERE ticker = 'DVN' AND i = pages - 2),
t AS (SELECT ticker, tok, count(*) AS landed, min_by(posts, page) AS posts, min(next) AS next,
             count(DISTINCT next) + max(CASE WHEN next IS NULL THEN 1 ELSE 0 END) > 1 AS fork FROM p GROUP BY ticker, tok),
w AS (SELECT ticker, CAST(0 AS BIGINT) AS pos, tok, [tok] AS path FROM t WHERE tok = ''
      UNION ALL
      SELECT w.ticker, w.pos + 1, v.tok, list_append(w.path, v.tok)
      FROM w JOIN t u ON u.ticker = w.ticker AND u.tok = w.tok AND NOT u.fork
      JOIN t v ON v.ticker = u.ticker AND v.tok = u.next WHERE NOT list_contains(w.path, v.tok)),
s AS (SELECT w.ticker, w.pos, t.* EXCLUDE (ticker), w.path FROM w JOIN t ON t.ticker = w.ticker AND t.tok = w.tok),
f AS (SELECT ticker, pos AS place, 'repeat' AS problem, tok AS token FROM s WHERE landed > 1 AND NOT fork
      UNION ALL SELECT ticker, pos, 'fork', tok FROM s WHERE fork
      UNION ALL SELECT ticker, pos + 1, CASE WHEN list_contains(path, next) THEN 'loop' ELSE 'gap' END, next
      FROM s WHERE pos = (SELECT max(pos) FROM s z WHERE z.ticker = s.ticker) AND NOT fork AND next IS NOT NULL),
first AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY place) = 1)
SELECT 'r1' AS run, g.ticker, g.pages_landed, c.chain_pages, c.chain_posts, problem, place AS problem_at,
       token AS problem_token, problem IS NULL AS complete
FROM (SELECT ticker, count(*) AS pages_landed FROM p GROUP BY ticker) g
JOIN (SELECT ticker, count(*) AS chain_pages, CAST(sum(posts) AS BIGINT) AS chain_posts FROM s GROUP BY ticker) c USING (ticker)
LEFT JOIN first USING (ticker)""")
def q_page_chain(spark, sf_dir):
    """Each search's cursor chain: a lost page, a loop, a page landed twice, a fork, none."""
    pages = read_pages(spark, _landed_pages(spark, sf_dir, "pages_chain")).select("run", "ticker", "page", "token", "meta")
    place = Window.partitionBy("ticker").orderBy("page")
    pages = (pages.withColumn("i", F.row_number().over(place))
             .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("ticker"))))
    i, n, ticker = F.col("i"), F.col("n"), F.col("ticker")
    back = F.max(F.when(i == 4, F.col("token"))).over(Window.partitionBy("ticker"))
    named = F.when((ticker == "CAT") & (i == n), back).otherwise(F.col("meta.next_token"))
    whole = pages.withColumn("meta", F.struct("meta.result_count", named.alias("next_token")))
    other = F.struct("meta.result_count", F.lit("elsewhere").alias("next_token"))
    damaged = (whole.where(~((ticker == "BAC") & (i == F.floor(n / 2))))
               .unionByName(whole.where((ticker == "ENPH") & (i == F.floor(n / 3))))
               .unionByName(whole.where((ticker == "DVN") & (i == n - 2)).withColumn("meta", other)))
    return chain_status(damaged.drop("i", "n"))


@register("json_pages_raw", f"""WITH {POSTS_CTE},
loads AS ({TWO_RUNS})
SELECT run, "user", created_at, id, text, ticker, page // {RAW_PAGES} AS page FROM loads""")
def q_json_pages_raw(spark, sf_dir):
    """One document per file, two runs, empty closing pages, a NULL key."""
    root = _land_two_runs(spark, sf_dir, "pages_raw", merge_pages=RAW_PAGES, file_per_page=True)
    return flatten_pages(read_pages(spark, root, multiline=True))


@register("bronze_bulk", f"""{BASE}
{_bronze_select('TRUE')}""")
def q_bronze_bulk(spark, sf_dir):
    path = scratch_path(spark, "bronze_bulk")
    bulk_load(_posts(spark, sf_dir), _dim(spark), path, RUN_DATE)
    return _dates_as_timestamps(read_bronze(spark, path))


@register("bronze_edges", f"""WITH e AS ({EDGE_BASE}
{_bronze_select('TRUE')})
SELECT * REPLACE (CAST(NULL AS VARCHAR) AS id) FROM e""")
def q_bronze_edges(spark, sf_dir):
    """Blanked ids; the excluded phrase in a post, and in another letter case."""
    path = scratch_path(spark, "bronze_edges")
    bulk_load(_edge_posts(spark, sf_dir), _dim(spark), path, RUN_DATE, blank_id=True)
    return _dates_as_timestamps(read_bronze(spark, path))


@register("bronze_incremental", f"""{BASE},
part1 AS ({_bronze_select(f"created_at < TIMESTAMP '{INCREMENTAL_CUT}'")}),
hwm AS (SELECT max(Twitter_Created_datetime) AS m FROM part1)
SELECT * FROM part1
UNION ALL
{_bronze_select("created_at >= (SELECT m FROM hwm) AND isodow(CAST(created_at AS DATE)) <= 5")}""")
def q_bronze_incremental(spark, sf_dir):
    path = scratch_path(spark, "bronze_incr")
    posts, dim = _posts(spark, sf_dir), _dim(spark)
    bulk_load(posts.where(F.col("created_at") < _ntz(INCREMENTAL_CUT)), dim, path, RUN_DATE)
    incremental_load(posts, dim, path, RUN_DATE)
    return _dates_as_timestamps(read_bronze(spark, path))


PER_TICKER_CUT = "2024-01-26 00:00:00"


@register("bronze_per_ticker", f"""{BASE}
{_bronze_select(f"ticker <> 'BAC' OR created_at < TIMESTAMP '{INCREMENTAL_CUT}' OR isodow(CAST(created_at AS DATE)) <= 5")}""")
def q_bronze_per_ticker(spark, sf_dir):
    """BAC was fetched early: two loads from each ticker's own mark, while the newest post of all stands still; none comes twice."""
    path, dim, posts = scratch_path(spark, "bronze_per_ticker"), _dim(spark), _posts(spark, sf_dir)
    for i, shown in enumerate((INCREMENTAL_CUT, PER_TICKER_CUT, RUN_DATE)):
        seen = posts.where((F.col("ticker") != "BAC") | (F.col("created_at") < _ntz(shown)))
        if i == 0:
            bulk_load(seen, dim, path, RUN_DATE)
        else:
            incremental_load(seen, dim, path, RUN_DATE, per_ticker=True, dedupe=True)
    return _dates_as_timestamps(read_bronze(spark, path))


@register("stream_append", f"""{BASE}
{_bronze_select('TRUE')}""")
def q_stream_append(spark, sf_dir):
    base = scratch_path(spark, "stream")
    stage, target = f"{base}/stage", f"{base}/bronze"
    rows = bronze_frame(_posts(spark, sf_dir), _dim(spark), RUN_DATE)
    cut = _ntz(INCREMENTAL_CUT)
    # two polling rounds: stage what arrived, stream it, stage more, stream again
    stage_posts(rows.where(F.col("Twitter_Created_datetime") < cut), stage)
    stream_to_bronze(spark, stage, target, max_files_per_trigger=4)
    stage_posts(rows.where(~(F.col("Twitter_Created_datetime") < cut)
                           | F.col("Twitter_Created_datetime").isNull()), stage)
    stream_to_bronze(spark, stage, target, max_files_per_trigger=4)
    return _dates_as_timestamps(read_bronze(spark, target))


@register("stream_by_name", f"""{BASE}, b AS ({_bronze_select('TRUE')})
SELECT Ticker, CAST(count(*) AS BIGINT) AS posts, (SELECT count(*) FROM b) AS audited_posts, (SELECT min(Twitter_Created_datetime) FROM b) AS audited_first,
       (SELECT max(Twitter_Created_datetime) FROM b) AS audited_last FROM b GROUP BY Ticker""")
def q_stream_by_name(spark, sf_dir):
    """A stage table streamed by its name in two rounds; posts per ticker in bronze beside the audit's sums."""
    base, name = scratch_path(spark, "by_name"), f"marketpulse_scratch.stage_{uuid.uuid4().hex[:12]}"
    target, audit, before = f"{base}/bronze", f"{base}/audit", spark.catalog.currentDatabase()
    rows, cut = bronze_frame(_posts(spark, sf_dir), _dim(spark), RUN_DATE), _ntz(INCREMENTAL_CUT)
    use_database(spark, "marketpulse_scratch")
    try:
        for part in (rows.where(F.col("Twitter_Created_datetime") < cut), rows.where(F.col("Twitter_Created_datetime") >= cut)):
            save_table(part.repartition(3), name, mode="append")
            stream_table_to_bronze(spark, name, target, audit, max_files_per_trigger=2)
    finally:
        spark.catalog.setCurrentDatabase(before)
        drop_table(spark, name)
    batches = read_audit(spark, audit)
    return read_bronze(spark, target).groupBy("Ticker").agg(F.count(F.lit(1)).alias("posts")).select(
        "Ticker", "posts", batches.agg(F.sum("posts")).scalar().alias("audited_posts"),
        batches.agg(F.min("first_post")).scalar().alias("audited_first"),
        batches.agg(F.max("last_post")).scalar().alias("audited_last"))


POLLS = ("2024-01-12 00:00:00", "2024-01-22 00:00:00", "2024-02-01 00:00:00")


@register("stream_polling", f"""{BASE}
{_bronze_select('TRUE')}""")
def q_stream_polling(spark, sf_dir):
    """Three rounds from bronze's own mark, two days looked back each; the second one breaks off between batches."""
    base = scratch_path(spark, "polling")
    stage, target, dim = f"{base}/stage", f"{base}/bronze", _dim(spark)
    posts, horizon = _posts(spark, sf_dir), timedelta(days=30)
    third = max(1, -(-spark.sparkContext.defaultParallelism // 3))  # files of a third of a round: every core writes and reads

    def broken(batch, batch_id):
        if batch_id % 2:  # the round's later batches are lost with the process
            raise RuntimeError("broke off")
        append_batch(batch, target, checkpoint_for(target, "polling"), batch_id)

    for i, now in enumerate(POLLS):
        shown = posts.where(F.col("created_at") < _ntz(now)).repartition(3 * third)
        how = {"max_files_per_trigger": third, "sink": broken} if i == 1 else {"max_files_per_trigger": 2 * third}
        try:
            poll(shown, dim, stage, target, datetime.fromisoformat(now), RUN_DATE, timedelta(days=2), horizon, **how)
        except StreamingQueryException:
            stream_new_posts(spark, stage, target, horizon, max_files_per_trigger=third)
    return _dates_as_timestamps(read_bronze(spark, target))


_KW_ROWS = [(t, k) for t, k, _ in COMPANIES] + DOCUMENT_SEARCHES
# the same dictionary with every odd entry: repeated, with outer blanks, without
# words, NULL keyword, NULL key
_KW_ODD_ROWS = [*_KW_ROWS, *DOCUMENT_SEARCHES, ("BLANKS", '  "Apache License" '), ("BLANKS2", " worthless "),
                ("EMPTY", '""'), ("NONE", None), (None, "der die")]
_KW_SCHEMA = StructType([StructField("ticker", StringType()), StructField("keyword", StringType())])


def _keyword_sql(rows) -> str:
    return """WITH kw_raw(ticker, keyword) AS (SELECT DISTINCT * FROM (VALUES """ + _values(rows) + r""")),
kw AS (SELECT ticker, keyword, length(trim(keyword)) >= 2 AND starts_with(trim(keyword), '"')
              AND ends_with(trim(keyword), '"') AS is_phrase,
              trim(regexp_replace(lower(keyword), '[^\p{L}\p{N}]+', ' ', 'g')) AS norm
       FROM kw_raw WHERE keyword IS NOT NULL),
docs AS (SELECT doc_id, ' ' || regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g') || ' ' AS nt
         FROM documents)
SELECT d.doc_id, k.ticker, k.keyword
FROM docs d JOIN kw k ON k.norm <> '' AND CASE WHEN k.is_phrase THEN contains(d.nt, ' ' || k.norm || ' ')
  ELSE list_bool_and(list_transform(string_split(k.norm, ' '), lambda w: contains(d.nt, ' ' || w || ' '))) END"""


@register("keyword_match", _keyword_sql(_KW_ROWS))
def q_keyword_match(spark, sf_dir):
    return match_keywords(table(spark, sf_dir, "documents"), literal_frame(spark, _KW_ROWS, _KW_SCHEMA))


@register("keyword_match_join", _keyword_sql(_KW_ROWS))
def q_keyword_match_join(spark, sf_dir):
    """Same matches with the dictionary shuffled instead of broadcast."""
    kw = literal_frame(spark, _KW_ROWS, _KW_SCHEMA).hint("shuffle_merge")
    return match_keywords(table(spark, sf_dir, "documents"), kw)


@register("keyword_dictionary", _keyword_sql(_KW_ODD_ROWS))
def q_keyword_dictionary(spark, sf_dir):
    """A dictionary with repeated, padded, wordless and NULL entries."""
    return match_keywords(table(spark, sf_dir, "documents"), literal_frame(spark, _KW_ODD_ROWS, _KW_SCHEMA))


@register("keyword_index", _keyword_sql(_KW_ODD_ROWS))
def q_keyword_index(spark, sf_dir):
    """All documents indexed in three loads; the odd dictionary searched in the index."""
    root, docs = scratch_path(spark, "index"), table(spark, sf_dir, "documents")
    for day in range(3):
        add_texts(docs.where(F.pmod("doc_id", F.lit(3)) == day), root, f"day-{day}")
    return search_index(read_index(spark, root), literal_frame(spark, _KW_ODD_ROWS, _KW_SCHEMA))
