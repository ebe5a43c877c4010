"""Landed search pages.

Each search response page is one JSON document ``{data: [...], meta:
{result_count, next_token}, token}``, ``token`` being the one it was requested with. Pages are landed under
``<root>/run=<R>/ticker=<T>/``, one ``run`` per load, so that a later load of the
same keys never mixes with an earlier one. They are either JSON lines
(one document per line, its sequence number in a top-level ``page`` field; the
default, few files) or one document per file under ``page=<n>/`` folders (raw
responses, ``multiline=True``). The ``run=`` level may be missing (``run`` is
then NULL). All pages of all runs and companies are read in one file scan (the
union of pages and of companies is the scan itself) with a declared schema,
and flattened with ``explode`` on the executors; no page ever passes through
the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketpulse.functions.columns import iso_z, parse_iso_utc
from marketpulse.schemas import LANDED_PAGE_SCHEMA

CHUNK_PAGES = 1024
MAX_PAGE_POSTS = 10_000  # a page is one JSON document; the source's own limit is far lower


def read_pages(spark: SparkSession, root: str, multiline: bool = False,
               strict: bool = True) -> DataFrame:
    """Page documents with their ``run``, ``ticker`` and ``page`` values.

    ``multiline=True`` reads one possibly pretty-printed document per file
    (raw responses); the default reads splittable JSON lines. A malformed page
    fails the read (like a failed request aborting a load); ``strict=False``
    turns it into an empty page instead.
    """
    return (spark.read.schema(LANDED_PAGE_SCHEMA)
            .option("multiLine", multiline)
            .option("mode", "FAILFAST" if strict else "PERMISSIVE")
            .json(root))


def page_meta(pages: DataFrame) -> DataFrame:
    """One row per page: ``run, ticker, page, result_count, is_last``."""
    return pages.select(
        "run", "ticker", "page",
        F.col("meta.result_count").alias("result_count"),
        F.col("meta.next_token").isNull().alias("is_last"),
    )


def flatten_pages(pages: DataFrame) -> DataFrame:
    """Posts of the non-empty pages (S3, S4): ``user, created_at, id, text, run, ticker, page``.

    ``created_at`` (ISO-8601 text) becomes a UTC wall-clock TIMESTAMP_NTZ;
    the ``source`` field is requested but not kept.
    """
    rc = F.col("meta.result_count")
    return (pages.where(rc.isNotNull() & (rc > 0))
            .select("run", "ticker", "page", F.explode("data").alias("p"))
            .select(
                F.col("p.author_id").alias("user"),
                parse_iso_utc(F.col("p.created_at")).alias("created_at"),
                F.col("p.id").alias("id"),
                F.col("p.text").alias("text"),
                "run", "ticker", "page",
            ))


def _neighbours(posts: DataFrame, key_col: str, page_col: str) -> DataFrame:
    """``_mp_key, _mp_page, _mp_first, _mp_next`` of each page: its key's first page and the following one.

    Found within chunks of page numbers and over the chunks of a key, so no window holds all pages of a key.
    """
    key, page, chunk = F.col(key_col).alias("_mp_key"), F.col(page_col).alias("_mp_page"), F.floor(F.col(page_col) / CHUNK_PAGES)
    pages = posts.select(key, page, chunk.alias("_mp_chunk")).distinct()
    over = Window.partitionBy("_mp_key").orderBy("_mp_chunk")
    chunks = (pages.groupBy("_mp_key", "_mp_chunk").agg(F.min("_mp_page").alias("_mp_lowest"))
              .select(F.col("_mp_key").alias("_mp_k"), F.col("_mp_chunk").alias("_mp_c"),
                      F.lead("_mp_lowest").over(over).alias("_mp_later"),
                      F.min("_mp_lowest").over(Window.partitionBy("_mp_key")).alias("_mp_first")))
    inner = Window.partitionBy("_mp_key", "_mp_chunk").orderBy("_mp_page")
    same = F.col("_mp_key").eqNullSafe(F.col("_mp_k")) & F.col("_mp_chunk").eqNullSafe(F.col("_mp_c"))
    return (pages.withColumn("_mp_near", F.lead("_mp_page").over(inner)).join(chunks, same)
            .select("_mp_key", "_mp_page", "_mp_first", F.coalesce("_mp_near", "_mp_later").alias("_mp_next")))


def page_token(key, page) -> Column:
    """The token of a page of a key."""
    return F.concat(F.coalesce(F.col(key), F.lit("")), F.lit("-"), page.cast("string"))


def land_pages(posts: DataFrame, root: str, key_col: str = "ticker", page_col: str = "page",
               run: str = "r1", file_per_page: bool = False, closing_page: bool = False) -> None:
    """Write one load run of posts as page documents (JSON lines, or one file per page).

    ``posts`` has ``user, created_at, id, text`` plus the key and a page
    sequence number; a page of more than ``MAX_PAGE_POSTS`` posts fails. Only
    this run's folder is replaced. A page gets the ``next_token`` of the following
    page of its key, if there is one, and its own as ``token`` unless it is the first; ``closing_page``
    adds an empty last page without ``data``, as the source sends when a full
    page was the last one. NULL keys are a key of their own.
    """
    post = F.struct(
        F.col("user").alias("author_id"),
        iso_z("created_at").alias("created_at"),
        F.col("id").alias("id"),
        F.lit(None).cast("string").alias("source"),
        F.col("text").alias("text"),
    )
    newest_first = F.sort_array(F.collect_list(F.struct(F.col("created_at").alias("t"), post.alias("p"))),
                                asc=False)
    grouped = posts.groupBy(key_col, page_col).agg(F.transform(newest_first, lambda x: x["p"]).alias("data"))
    near = _neighbours(posts, key_col, page_col)
    same = F.col(key_col).eqNullSafe(F.col("_mp_key")) & F.col(page_col).eqNullSafe(F.col("_mp_page"))
    full = F.size("data") <= MAX_PAGE_POSTS
    following = F.coalesce("_mp_next", F.col(page_col) + 1) if closing_page else F.col("_mp_next")
    docs = (grouped.join(near, same)
            .withColumn("data", F.when(full, F.col("data")).otherwise(
                F.raise_error(F.lit(f"a page holds more than {MAX_PAGE_POSTS} posts"))))
            .select("data", key_col, page_col, F.size("data").cast("bigint").alias("result_count"),
                    F.when(F.col(page_col) != F.col("_mp_first"), page_token(key_col, F.col(page_col))).alias("token"),
                    page_token(key_col, following).alias("next_token")))
    if closing_page:
        last = posts.groupBy(key_col).agg((F.max(page_col) + 1).alias(page_col))
        docs = docs.unionByName(last.select(
            F.lit(None).cast(docs.schema["data"].dataType).alias("data"), key_col, page_col,
            F.lit(0).cast("bigint").alias("result_count"), page_token(key_col, F.col(page_col)).alias("token"),
            F.lit(None).cast("string").alias("next_token")))
    docs = docs.select("data", F.struct("result_count", "next_token").alias("meta"), "token", key_col, page_col)
    parts = [key_col, page_col] if file_per_page else [key_col]
    # keys with many pages are written by several tasks, small ones share a task
    docs.hint("rebalance", key_col).write.mode("overwrite").partitionBy(*parts).json(f"{root}/run={run}")
