"""Whether all pages of a search are there: its cursor chain, by list ranking.

The pages of one search (run, key) are a linked list: the first is requested
without a token, each names the token of the next in ``next_token``, the last
names none. Pages can be lost, landed twice, answered differently for one token, or
point back. The walk from the first page is not done step by step:

1. Per token one node (partial aggregate): pages landed, posts, next token,
   whether its pages disagree on the next token (a fork, where the walk ends).
2. Neighbouring pages whose link is certain (the next token is that page's
   own, no other page names it) are contracted to segments in one sorted pass per chunk
   of ``chunk_pages`` page numbers. A chain in order becomes one segment per chunk.
3. Pointer doubling over the segments: in round k the segments within 2^k
   links of the first are known with their rank, and every pointer spans 2^k links.
   Rounds are the logarithm of the segments of the longest chain, whatever its order.

Everything is keyed by (search, token), so a search holding a third of all pages is
spread over its tokens and chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketpulse.session import scratch_path

CHUNK_PAGES = 1024
START = ""  # the token of a first page


def _written(df: DataFrame, name: str) -> DataFrame:
    spark, folder = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def page_links(pages: DataFrame) -> DataFrame:
    """``search, page, at, to, posts`` of landed pages: own token, next token, posts.

    Pages of a run that was landed without the tokens of its requests are linked by page
    number: the smallest is the first, and a page with a next token is followed
    by the next number.
    """
    search = F.to_json(F.struct("run", "ticker"))  # leaves NULLs out: NULL keys are keys too
    posts = F.coalesce(F.col("meta.result_count"), F.lit(0))
    token = F.col("token") if "token" in pages.columns else F.lit(None).cast("string")
    rows = pages.select(search.alias("search"), F.to_json(F.struct("run")).alias("run"), "page", F.nullif(token, F.lit(START)).alias("token"),
                        F.nullif(F.col("meta.next_token"), F.lit(START)).alias("to"), posts.alias("posts"))
    per = rows.groupBy("run", "search").agg(F.min("page").alias("first"), F.max(F.col("token").isNotNull()).alias("tokens"))
    per = per.select("run", "search", "first").join(per.groupBy("run").agg(F.max("tokens").alias("tokens")), "run").drop("run")
    numbered = F.when(F.col("page") == F.col("first"), START).otherwise(F.concat(F.lit("page "), F.col("page").cast("string")))
    following = F.when(F.col("to").isNotNull(), F.concat(F.lit("page "), (F.col("page") + 1).cast("string")))
    return rows.join(per, "search").select(
        "search", "page", F.when(F.col("tokens"), F.coalesce("token", F.lit(START))).otherwise(numbered).alias("at"),
        F.when(F.col("tokens"), F.col("to")).otherwise(following).alias("to"), "posts")


def _nodes(links: DataFrame) -> DataFrame:
    """One row per token: ``search, at, page, landed, posts, to, fork``; the posts are those of its lowest page (ties: the fewest)."""
    some, none = F.count("to") > 0, F.count("to") < F.count(F.lit(1))
    return (links.groupBy("search", "at")
            .agg(F.min("page").alias("page"), F.count(F.lit(1)).alias("landed"), F.min(F.struct("page", "posts")).alias("lowest"),
                 F.min("to").alias("to"), ((F.min("to") != F.max("to")) | (some & none)).alias("fork"))
            .select("search", "at", "page", "landed", F.col("lowest.posts").alias("posts"), "to",
                    F.coalesce("fork", F.lit(False)).alias("fork")))


def _segments(nodes: DataFrame, chunk_pages: int) -> DataFrame:
    """``search, head, last, to, fork, tokens, posts, repeat, repeat_at``: chains of certain links as one row.

    ``repeat`` is the offset of the first page landed twice, ``last`` the token of the last page.
    """
    named = nodes.where(~F.col("fork") & F.col("to").isNotNull()).groupBy("search", "to").agg(F.count(F.lit(1)).alias("named"))
    named = named.select(F.col("search").alias("s"), F.col("to").alias("t"), "named")
    known = nodes.join(named, (F.col("search") == F.col("s")) & (F.col("at") == F.col("t")), "left").drop("s", "t")
    chunk = F.floor(F.col("page") / chunk_pages)
    order = Window.partitionBy("search", "chunk").orderBy("page", "at")
    linked = ((F.col("named") == 1) & ~F.lag("fork").over(order) & (F.lag("to").over(order) == F.col("at")))
    begins = F.when(F.coalesce(linked, F.lit(False)), 0).otherwise(1)
    rows = (known.withColumn("chunk", chunk).withColumn("begins", begins)
            .withColumn("segment", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0))))
    place = Window.partitionBy("search", "chunk", "segment").orderBy("page", "at")
    rows = rows.withColumn("offset", F.row_number().over(place) - 1)
    again = F.when((F.col("landed") > 1) & ~F.col("fork"), F.struct("offset", "at"))
    return (rows.groupBy("search", "chunk", "segment")
            .agg(F.min_by("at", "offset").alias("head"), F.max_by("at", "offset").alias("last"),
                 F.max_by("to", "offset").alias("to"), F.max_by("fork", "offset").alias("fork"), F.count(F.lit(1)).alias("tokens"), F.sum("posts").alias("posts"),
                 F.min(again).alias("again"))
            .select("search", "head", "last", "to", "fork", "tokens", "posts", F.col("again.offset").alias("repeat"),
                    F.col("again.at").alias("repeat_at")))


def _ranked(segments: DataFrame) -> DataFrame:
    """``search, head, rank`` of the segments on the walk from the first page; rank in pages."""
    heads = segments.select("search", F.col("head").alias("to"))
    jumps = (segments.where(~F.col("fork") & F.col("to").isNotNull()).select("search", F.col("head").alias("at"), "to", "tokens")
             .join(heads, ["search", "to"], "left_semi").select("search", "at", "to", F.col("tokens").alias("far")))
    reached = segments.where(F.col("head") == START).select("search", F.col("head").alias("at"), F.lit(0).cast("bigint").alias("rank"))
    jumps, n = _written(jumps, "chain-jumps"), None
    while not jumps.isEmpty():
        further = reached.join(jumps, ["search", "at"]).select("search", F.col("to").alias("at"), (F.col("rank") + F.col("far")).alias("rank"))
        reached = _written(reached.unionByName(further).groupBy("search", "at").agg(F.min("rank").alias("rank")), "chain-reached")
        before, n = n, reached.count()
        if n == before:  # every walk has ended or come back to itself
            break
        onward = jumps.select("search", F.col("at").alias("to"), F.col("to").alias("then"), F.col("far").alias("more"))
        jumps = _written(jumps.join(onward, ["search", "to"]).select("search", "at", F.col("then").alias("to"),
                                                                    (F.col("far") + F.col("more")).alias("far")), "chain-jumps")
    return reached.select("search", F.col("at").alias("head"), "rank")


def chain_status(pages: DataFrame, chunk_pages: int = CHUNK_PAGES) -> DataFrame:
    """One row per search: ``run, ticker, pages_landed, chain_pages, chain_posts, problem, problem_at, problem_token, complete``.

    ``pages`` are landed pages (``run, ticker, page, token, meta``). The chain is
    walked from the page without a token: ``chain_pages`` tokens and ``chain_posts`` posts are
    reachable, a token landed several times counting once (its lowest page number, then fewest posts). ``problem`` is
    the first thing wrong on the walk, ``problem_at`` its place in pages from 0 and
    ``problem_token`` the token concerned:

    * ``gap``: the token is named (or it is the first page) but its page is not there;
    * ``fork``: pages of the token name different next tokens; the walk ends here;
    * ``loop``: the token was visited before;
    * ``repeat``: the token's page landed more than once.

    ``complete``: no problem, so the walk ends at a page without a next token.
    Pages off the chain do not matter but for ``pages_landed``.
    """
    nodes = _nodes(page_links(pages))
    segments = _written(_segments(nodes, chunk_pages), "chain-segments")
    walk = segments.join(_ranked(segments), ["search", "head"])
    problem = walk.groupBy("search").agg(
        F.max("rank").alias("top"), F.sum("tokens").alias("chain_pages"), F.sum("posts").alias("chain_posts"),
        F.max_by("to", "rank").alias("to"), F.max_by("fork", "rank").alias("fork"), F.max_by("last", "rank").alias("last"),
        F.max(F.col("rank") + F.col("tokens")).alias("end"),
        F.min(F.when(F.col("repeat").isNotNull(), F.struct((F.col("rank") + F.col("repeat")).alias("at"), "repeat_at"))).alias("again"))
    # the last segment's next token: on the walk already (a loop), or not there (a gap)
    seen = walk.select(F.col("search").alias("s"), F.col("head").alias("h"), F.lit(True).alias("seen"))
    problem = problem.join(seen, (F.col("search") == F.col("s")) & (F.col("to") == F.col("h")), "left")
    totals = pages.groupBy("run", "ticker").agg(F.count(F.lit(1)).alias("pages_landed"))
    totals = totals.withColumn("search", F.to_json(F.struct("run", "ticker")))
    found = [_problem("repeat", F.col("again").isNotNull(), F.col("again.at"), F.col("again.repeat_at")),
             _problem("fork", F.col("fork"), F.col("end") - 1, F.col("last")),
             _problem("loop", ~F.col("fork") & F.col("to").isNotNull() & F.col("seen").isNotNull(), F.col("end"), F.col("to")),
             _problem("gap", ~F.col("fork") & F.col("to").isNotNull() & F.col("seen").isNull(), F.col("end"), F.col("to")),
             _problem("gap", F.col("top").isNull(), F.lit(0), F.lit(START))]
    out = totals.join(problem, "search", "left").withColumn("first", F.least(*found))
    return out.select("run", "ticker", "pages_landed", F.coalesce("chain_pages", F.lit(0)).cast("bigint").alias("chain_pages"),
                      F.coalesce("chain_posts", F.lit(0)).cast("bigint").alias("chain_posts"),
                      F.col("first.problem").alias("problem"), F.col("first.at").alias("problem_at"),
                      F.col("first.token").alias("problem_token"), F.col("first").isNull().alias("complete"))


def _problem(name: str, when: Column, at: Column, token: Column) -> Column:
    return F.when(when, F.struct(at.cast("bigint").alias("at"), F.lit(name).alias("problem"), token.alias("token")))
