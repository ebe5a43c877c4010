"""Page-granular cap per load run and search key.

Pages of one key are visited in sequence; before each page the visit stops
when the rows taken so far already reach the cap, so the page that crosses
the cap is kept whole. Equivalently: keep page ``p`` iff the rows of the
earlier pages of its key sum to less than the cap. Every run starts its own
count. A NULL run or key is a run or key of its own; pages that repeat a page
number are separate pages, in the order of a hash of their content.

Prefix sums in two levels, for any cap: the pages of a key are cut into chunks
of ``chunk_pages`` page numbers, chunk totals (one row per chunk) are summed
over the chunks of a key, and only chunks that start below the cap are kept;
within those a running sum per (key, chunk) decides. So the payloads of pages
that cannot be kept are never shuffled, and a key holding a third of all
pages is spread over its chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketpulse.functions.columns import all_of

CHUNK_PAGES = 1024


def cap_pages(pages: DataFrame, cap: int, key_col: str = "ticker", order_col: str = "page",
              count_col: str = "result_count", run_col: str = "run", chunk_pages: int = CHUNK_PAGES) -> DataFrame:
    """Keep the pages the capped visit would fetch; adds ``rows_before``.

    ``pages`` holds one row per page with its row count in ``count_col``
    (any other columns, e.g. the page's posts, are carried along); empty
    pages (count NULL or 0) carry no rows and are dropped. ``run_col`` is
    optional in the input.
    """
    n = F.col(count_col)
    keys = [c for c in (run_col, key_col) if c in pages.columns]
    chunk = F.expr(f"floor({order_col} / {int(chunk_pages)})")
    nonempty = pages.where(n > 0).withColumn("_mp_chunk", chunk)
    by_key = Window.partitionBy(*keys).orderBy("_mp_chunk")
    chunks = (nonempty.groupBy(*keys, "_mp_chunk").agg(F.sum(n).alias("_mp_total"))
              .withColumn("_mp_base", F.coalesce(F.sum("_mp_total").over(
                  by_key.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .where(F.col("_mp_base") < cap)
              .select(*[F.col(c).alias(f"_mp_{c}") for c in keys], F.col("_mp_chunk").alias("_mp_c"), "_mp_base"))
    same = all_of([F.col(c).eqNullSafe(F.col(f"_mp_{c}")) for c in keys]
                  + [F.col("_mp_chunk").eqNullSafe(F.col("_mp_c"))])
    near = nonempty.join(chunks, same)
    tie = F.xxhash64(*[c for c, t in pages.dtypes if not t.startswith("map")])
    in_chunk = Window.partitionBy(*keys, "_mp_chunk").orderBy(F.col(order_col).asc(), tie)
    earlier = F.sum(n).over(in_chunk.rowsBetween(Window.unboundedPreceding, -1))
    return (near.withColumn("rows_before", F.col("_mp_base") + F.coalesce(earlier, F.lit(0)))
            .where(F.col("rows_before") < cap)
            .select(*pages.columns, "rows_before"))
