"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketpulse.llm.common import cut


def _least_neighbour(links: DataFrame) -> DataFrame:
    """Adds ``m``, the least of ``u`` and its neighbours ``v``, to every link.

    The minimum is combined map-side; only the join back moves a hub's links,
    and Spark splits it where one hub dominates.
    """
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    return links.join(least, "u").withColumn("m", F.least("m", "u"))


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of the links ``u, v`` (longs).

    ``component`` is the least node of the component. Loops and repeated
    links are allowed; no links give no rows. Each round is two joins over the
    links left, which never become more; rounds grow with the logarithm of
    the longest path. Links are cut into the shared checkpoint folder per
    round, and only their count and a hash sum reach the driver.
    """
    links = cut(links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    for _ in range(max_rounds):
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state or not now[0]:
            break
        state = tuple(now)
        # large star: neighbours above u hang on u's least neighbour
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least_neighbour(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its neighbours below u hang on the least of them
        small = _least_neighbour(large)
        links = cut(small.select("u", F.col("m").alias("v"))
                    .unionByName(small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")))
                    .where("u != v").distinct())
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (links.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
