"""Mixing sources to target weights by Sainte-Lague apportionment of equal word blocks.

1. Every source gets a target: its weight's share of the budget, at most
   ``max_repeat`` times its size, the excess reshared by weight until no
   target is above its limit (water filling, in closed form).
2. The budget is cut into blocks of ``block`` words. Blocks go to sources by
   the highest quotients target / (2 k - 1), and each source's blocks to its
   shards in the same way, so every shard gets an integer quota. Of it a shard
   takes at most ``max_repeat`` times its size; the words above that go to the
   source's shards with room left, in the order of their numbers, so a source
   takes its whole quota or all its words ``max_repeat`` times.
3. Within a (source, shard) documents lie one after another in the order of a
   seeded digest; the shard takes whole passes over itself and then the first
   blocks of that seeded order until its quota is used.

Shards hold about ``shard_docs`` documents of all sources together, so a
source holding a third of all rows spreads over all shards. A source with few
words or documents has fewer shards, so that one holds ``SHARD_BLOCKS`` blocks
and as many documents on average at any size of the table. Only narrow
rows (id, source, size) are shuffled; the per-source and per-shard tables grow
with the number of sources and shards, not of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketpulse.llm.common import WORD, cut, text_or_empty

WEIGHTS = (3, 1, 2)
BUDGET_PERCENT = 150
MAX_REPEAT = 2
BLOCK = 32
SHARD_DOCS = 4096
SHARD_BLOCKS = 64
SEED = "mix-1"


def sainte_lague(parties: DataFrame, group: list[str], party: list[str], votes: str, seats: str) -> DataFrame:
    """Adds ``quota``: the integer seats of each party of a group of ``seats`` seats.

    The seats go to the highest quotients votes / (2 k - 1). Rounding
    votes / d gives at most the group's seats for a divisor d somewhat too
    large, and at least as many for one somewhat too small; only the seats
    between the two roundings are listed and ranked, about three per party.
    """
    whole = Window.partitionBy(*group)
    total, count, m = F.sum(votes).over(whole), F.count(F.lit(1)).over(whole), F.col(seats)
    v = F.col(votes).cast("double")
    bounds = (parties.withColumn("_total", total.cast("double")).withColumn("_count", count)
              .withColumn("_low", F.when((F.col("_total") > 0) & (m > F.col("_count")),
                                         F.floor(v * (m - F.col("_count")) / F.col("_total") + 0.5))
                          .otherwise(F.lit(0)))
              .withColumn("_high", F.when(F.col("_total") > 0,
                                          F.floor(v * (m + F.col("_count")) / F.col("_total") + 0.5) + 1)
                          .otherwise(F.lit(0))))
    # _low may round one seat more than allowed when a party's exact share ends in a half
    bounds = bounds.withColumn("_low", F.greatest(F.col("_low") - 1, F.lit(0)))
    rest = (bounds.withColumn("_left", m - F.sum("_low").over(whole))
            .where(F.col("_high") > F.col("_low"))
            .select(*group, *party, votes, "_left", F.explode(F.sequence(F.col("_low") + 1, F.col("_high"))).alias("_k")))
    order = Window.partitionBy(*group).orderBy((F.col(votes) / (2 * F.col("_k") - 1)).desc(), *party)
    won = (rest.where(F.col(votes) > 0).withColumn("_rank", F.row_number().over(order))
           .where(F.col("_rank") <= F.col("_left"))
           .groupBy(*group, *party).agg(F.count(F.lit(1)).alias("_won")))
    return (bounds.join(won, [*group, *party], "left")
            .withColumn("quota", (F.col("_low") + F.coalesce("_won", F.lit(0))).cast("long"))
            .drop("_total", "_count", "_low", "_high", "_won"))


def source_targets(sources: DataFrame, weights=WEIGHTS, budget_percent: int = BUDGET_PERCENT,
                   max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Adds ``target`` to ``source_key, source_size`` (keys sort as the sources do, null last)."""
    all_ = Window.partitionBy(F.lit(0))
    n = F.row_number().over(all_.orderBy("source_key")) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (n % len(weights) + 1).cast("int"))
    filled = (sources.withColumn("weight", weight)
              .withColumn("cap", F.lit(max_repeat) * F.col("source_size"))
              .withColumn("budget100", F.lit(budget_percent) * F.sum("source_size").over(all_)))
    by_level = all_.orderBy(F.col("cap") / F.col("weight"), "source_key")
    # the water level if all sources of a lower relative limit are full
    before = F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    level = (F.col("budget100") - 100 * before) / (100 * after)
    return (filled.withColumn("level", level).withColumn("level", F.max("level").over(all_))
            .withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")))
            .drop("level", "cap", "weight"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, budget_percent: int = BUDGET_PERCENT, max_repeat: int = MAX_REPEAT,
        block: int = BLOCK, shard_docs: int = SHARD_DOCS, seed: str = SEED, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken`` and the ``carry`` columns.

    ``size`` counts words (null or empty text: 0, and takes nothing). A null
    source is a source of its own, sorted last; the empty string is another.
    Rows alike in id and size are interchangeable: which of them takes more is
    open, the set of result rows is not. A table without words has targets 0.
    Other columns are ignored. ``taken`` never exceeds ``max_repeat * size``.
    """
    digest = F.md5(F.concat(F.lit(seed + "|"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    # the prefix keeps null apart from every string, and after all of them
    key = F.when(F.col(source_col).isNull(), "1").otherwise(F.concat(F.lit("0"), F.col(source_col).cast("string")))
    rows = cut(docs.select(F.col(id_col).alias("doc_id"), key.alias("source_key"), digest.alias("digest"), *carry,
                           F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long").alias("size")))
    n = rows.agg(F.count(F.lit(1))).first()[0]
    n_shards = max(1, -(-n // shard_docs))
    own = Window.partitionBy("source_key")
    place = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("spread", place % n_shards)
    # joined by shard as well, so that a large source is not joined in one task
    few = (rows.groupBy("source_key", "spread").agg(F.sum("size").alias("words"), F.count_if(F.col("size") > 0).alias("texts"))
           .select("source_key", "spread", F.least((F.sum("words").over(own) / (SHARD_BLOCKS * block)).cast("long"),
                                                   (F.sum("texts").over(own) / SHARD_BLOCKS).cast("long"),
                                                   F.lit(n_shards)).alias("few")))
    # rows without words take nothing: they need no place beside others and stay spread over all shards
    rows = (rows.join(few, ["source_key", "spread"])
            .withColumn("shard", F.when(F.col("size") > 0, place % F.greatest("few", F.lit(1))).otherwise(F.col("spread")))
            .drop("few", "spread"))

    shards = rows.groupBy("source_key", "shard").agg(F.sum("size").alias("shard_size"))
    sources = source_targets(shards.groupBy("source_key").agg(F.sum("shard_size").alias("source_size")),
                             weights, budget_percent, max_repeat)
    seats = F.floor(F.col("budget100") / (100 * block) + 0.5)
    sources = (sainte_lague(sources.withColumn("all", F.lit(0)).withColumn("seats", seats),
                            ["all"], ["source_key"], "target", "seats")
               .select("source_key", "source_size", "target", F.col("quota").alias("source_quota")))
    given, most = F.col("quota") * block, max_repeat * F.col("shard_size")
    room_before = F.sum("room").over(own.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)) - F.col("room")
    quotas = (sainte_lague(shards.join(sources, "source_key"), ["source_key"], ["shard"], "shard_size", "source_quota")
              .withColumn("room", F.greatest(most - given, F.lit(0)))
              .withColumn("trimmed", F.sum(F.greatest(given - most, F.lit(0))).over(own))
              .withColumn("more", F.least(F.greatest(F.col("trimmed") - room_before, F.lit(0)), F.col("room")))
              .withColumn("words", F.least(given, most) + F.col("more"))
              .withColumn("passes", F.coalesce(F.expr("words div nullif(shard_size, 0)"), F.lit(0)))
              .withColumn("rest", F.col("words") - F.col("passes") * F.col("shard_size")))

    order = Window.partitionBy("source_key", "shard").orderBy("digest", "doc_id", "size")
    placed = rows.withColumn("before", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    part = F.least(F.greatest(F.col("rest") - F.col("before"), F.lit(0)), F.col("size"))
    return (placed.join(quotas, ["source_key", "shard"])
            .select("doc_id", "size", "source_size", "target",
                    (F.col("passes") * F.col("size") + part).cast("long").alias("taken"), *carry))


# Seats are dealt one by one here: every quotient of every source and shard is listed and ranked.
ORACLE = rf"""
WITH docs AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS source_key,
         md5('{SEED}|' || coalesce(doc_id::VARCHAR, 'null')) AS digest,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
nn AS (SELECT greatest(1, ceil(count(*) / {SHARD_DOCS}.0))::BIGINT AS n FROM docs),
few AS (SELECT source_key, greatest(1, least(sum(size)::BIGINT // {SHARD_BLOCKS * BLOCK}, count(*) FILTER (size > 0) // {SHARD_BLOCKS},
               max(nn.n))) AS few FROM docs, nn GROUP BY 1),
rows_ AS (SELECT docs.*, ('0x' || substr(digest, 1, 8))::BIGINT % CASE WHEN size > 0 THEN few ELSE nn.n END AS shard
          FROM docs JOIN few USING (source_key), nn),
src AS (SELECT source_key, sum(size)::BIGINT AS source_size FROM rows_ GROUP BY 1),
wt AS (SELECT *, list_extract([{", ".join(map(str, WEIGHTS))}], 1 + ((row_number() OVER (ORDER BY source_key) - 1) % {len(WEIGHTS)})::INT) AS w,
              {BUDGET_PERCENT} * sum(source_size) OVER () AS budget100 FROM src),
lv AS (SELECT *, (budget100 - 100 * coalesce(sum({MAX_REPEAT} * source_size) OVER (ORDER BY {MAX_REPEAT} * source_size / w, source_key
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
                 / (100 * sum(w) OVER (ORDER BY {MAX_REPEAT} * source_size / w, source_key
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS lev FROM wt),
tg AS (SELECT source_key, source_size, budget100,
              least(({MAX_REPEAT} * source_size)::DOUBLE, w * max(lev) OVER ()) AS target FROM lv),
q1 AS (SELECT source_key, k, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, source_key) AS rk,
              floor(budget100 / {100 * BLOCK} + 0.5) AS seats
       FROM (SELECT *, unnest(range(1, (target / {BLOCK})::BIGINT + 200)) AS k FROM tg WHERE target > 0)),
sq AS (SELECT source_key, count(*) AS sq FROM q1 WHERE rk <= seats GROUP BY 1),
sh AS (SELECT source_key, shard, sum(size)::BIGINT AS shard_size FROM rows_ GROUP BY 1, 2),
q2 AS (SELECT source_key, shard, sq, row_number() OVER (PARTITION BY source_key ORDER BY shard_size::DOUBLE / (2 * k - 1) DESC, shard) AS rk
       FROM (SELECT sh.*, sq.sq, unnest(range(1, sq.sq + 2)) AS k FROM sh JOIN sq USING (source_key) WHERE shard_size > 0)),
quota AS (SELECT source_key, shard, count(*) AS quota FROM q2 WHERE rk <= sq GROUP BY 1, 2),
given AS (SELECT sh.*, coalesce(quota, 0) * {BLOCK} AS given, {MAX_REPEAT} * shard_size AS most
          FROM sh LEFT JOIN quota USING (source_key, shard)),
room AS (SELECT *, greatest(most - given, 0) AS room, sum(greatest(given - most, 0)) OVER (PARTITION BY source_key) AS trimmed,
                coalesce(sum(greatest(most - given, 0)) OVER (PARTITION BY source_key ORDER BY shard
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room_before FROM given),
placed AS (SELECT r.*, room.shard_size, (least(given, most) + least(greatest(trimmed - room_before, 0), room))::BIGINT AS words,
             (sum(size) OVER (PARTITION BY source_key, shard ORDER BY digest, doc_id NULLS FIRST, size
                              ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS before_
           FROM rows_ r JOIN room USING (source_key, shard))
SELECT doc_id, size, source_size, target,
       (CASE WHEN shard_size = 0 THEN 0 ELSE (words // shard_size) * size
          + least(greatest(words - (words // shard_size) * shard_size - before_, 0), size) END)::BIGINT AS taken
FROM placed JOIN tg USING (source_key)
"""
