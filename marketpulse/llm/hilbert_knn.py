"""Nearest neighbours by windows on several shifted Hilbert curves.

Each curve has a random projection to ``DIMS`` dimensions, spreads every
projected dimension evenly over its range (quantiles of a bounded sample),
shifts it, and orders all vectors by their Hilbert key. The key range of a
curve is cut into ``WINDOWS`` ranges of equal numbers of rows (percentiles over all
rows). A query looks at its own range and both neighbours, on every curve; the
candidates are reranked by exact distance and the curves' lists merge.

On vectors without structure a curve's window holds a true neighbour little more
often than its share of rows, so windows are a share of the rows (3 of
``WINDOWS``, fewer windows if they would hold under ``WINDOW_ROWS``), not a
number: recall stays the same at every size, and work grows with queries x rows
x that share. Windows larger than ``UNIT`` rows are cut into salted units, and
so are the queries of a window, so a task holds about two units of vectors.

Equal vectors are one candidate (a group may hold a third of all rows): each
distinct vector keeps its ``k + 1`` smallest ids, which is all a result can use.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketpulse.llm.common import cut

CURVES = 20
DIMS = 8
BITS = 6
WINDOWS = 32
WINDOW_ROWS = 16
UNIT = 4096
SAMPLE = 4000


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of integer coordinates below 2 ** bits.

    Gray-code form of the curve: from the highest bit plane down, a set bit
    inverts the lower bits of the first axis and a clear one swaps them with
    this axis; what is left is a Gray code of the interleaved position.
    """
    x = cells.astype(np.int64).T.copy()
    axes = len(x)
    for plane in range(bits - 1, 0, -1):
        lower = (1 << plane) - 1
        for axis in range(axes):
            turned = (x[axis] >> plane & 1).astype(bool)
            swap = np.where(turned, 0, (x[0] ^ x[axis]) & lower)
            x[0] ^= np.where(turned, lower, swap)
            x[axis] ^= swap
    for axis in range(1, axes):
        x[axis] ^= x[axis - 1]
    flips = np.zeros_like(x[0])
    for plane in range(bits - 1, 0, -1):
        flips ^= np.where(x[-1] >> plane & 1, (1 << plane) - 1, 0)
    x ^= flips
    key = np.zeros_like(x[0])
    for plane in range(bits - 1, -1, -1):
        for axis in range(axes):
            key = key << 1 | (x[axis] >> plane & 1)
    return key


def usable(col: str) -> Column:
    """Not null, without null, NaN or infinite components, and not zero."""
    bad = F.exists(col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(col).isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(col, lambda x: x != 0)


class Curves:
    """The projections, spreads and shifts of all curves."""

    def __init__(self, sample: np.ndarray, curves: int, dims: int, bits: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.bits = bits
        self.maps = [rng.normal(size=(sample.shape[1], dims)) for _ in range(curves)]
        self.shifts = rng.random((curves, dims))
        self.spread = [np.sort(sample @ m, axis=0) for m in self.maps]

    def keys(self, vectors: np.ndarray, curve: int) -> np.ndarray:
        flat = vectors @ self.maps[curve]
        ranks = np.stack([np.searchsorted(s, y) / len(s) for s, y in zip(self.spread[curve].T, flat.T)], axis=1)
        cells = (ranks + self.shifts[curve]) / 2 * (1 << self.bits)
        return hilbert_keys(np.clip(cells, 0, (1 << self.bits) - 1), self.bits)


def _nearest(k: int):
    """The k nearest candidates of each query of one unit, ties to the smaller id."""

    def run(frame):
        import pandas as pd

        asked = frame[frame["asks"]]
        given = frame[~frame["asks"]]
        out = []
        if len(asked) and len(given):
            given = given.sort_values("rep")
            c = np.stack(given["embedding"].to_numpy()).astype(float)
            ids = given["rep"].to_numpy()
            q_all = np.stack(asked["embedding"].to_numpy()).astype(float)
            for a in range(0, len(asked), 512):
                q = q_all[a:a + 512]
                rough = (q ** 2).sum(1)[:, None] + (c ** 2).sum(1)[None] - 2 * q @ c.T
                slack = 1e-9 * ((q ** 2).sum(1) + (c ** 2).sum(1).max())
                for i, asker in enumerate(asked["rep"].to_numpy()[a:a + 512]):
                    edge = np.partition(rough[i], k - 1)[k - 1] if len(c) > k else np.inf
                    near = np.flatnonzero(rough[i] <= edge + slack[i])
                    exact = np.sqrt(((c[near] - q[i]) ** 2).sum(1))
                    best = np.lexsort((ids[near], exact))[:k]
                    out += [(asker, r, d) for r, d in zip(ids[near][best].tolist(), exact[best].tolist())]
        return pd.DataFrame(out, columns=["asker", "rep", "score"]).astype({"asker": "int64", "rep": "int64", "score": "float64"})

    return run


def knn(vectors: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding",
        curves: int = CURVES, dims: int = DIMS, bits: int = BITS, windows: int = WINDOWS, unit: int = UNIT,
        sample: int = SAMPLE) -> DataFrame:
    """``query_id, rank, vec_id, score``: up to ``k`` near rows of every row whose id is divisible by ``every``.

    ``score`` is the exact Euclidean distance in double precision; ties go to
    the smaller id. Vectors that are null, zero or hold null or non-finite
    components take no part, nor do rows without id or vectors of another
    length than the most frequent one. Rows repeated with one id are
    different candidates, but a row is never a candidate of its own id. Extra
    columns are ignored; an empty table gives no rows.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable("embedding"))
    size = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if size is None:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = rows.where(F.size("embedding") == size[0])

    # distinct vectors by their smallest id; members: the k + 1 smallest ids of each
    distinct = cut(rows.groupBy("embedding").agg(F.min("vec_id").alias("rep")))
    named = cut(rows.join(distinct, "embedding").select("vec_id", "rep"))
    first = Window.partitionBy("rep").orderBy("vec_id")
    members = (named.withColumn("i", F.row_number().over(first)).where(F.col("i") <= k + 1)
               .groupBy("rep").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    queries = named.where(F.col("vec_id") % every == 0)

    picked = distinct.orderBy(F.xxhash64(F.lit("hilbert"), "rep")).limit(sample).collect()
    shape = Curves(np.array([r.embedding for r in picked], float), curves, dims, bits)
    shared = vectors.sparkSession.sparkContext.broadcast(shape)  # bounded by the sample

    def keyed(frames):
        import pandas as pd

        for f in frames:
            if len(f):
                x = np.stack(f["embedding"].to_numpy()).astype(float)
                for c in range(curves):
                    yield pd.DataFrame({"curve": c, "key": shared.value.keys(x, c), "rep": f["rep"].to_numpy()})

    n_rows = distinct.count()
    windows = max(1, min(windows, n_rows // WINDOW_ROWS))  # a window holds more than a result needs
    keys = cut(distinct.mapInPandas(keyed, "curve int, key long, rep long"))
    cuts = [i / windows for i in range(1, windows)]
    bounds = keys.groupBy("curve").agg(F.percentile_approx("key", cuts, 10_000).alias("bounds"))  # one row per curve
    below = F.filter(F.coalesce("bounds", F.array().cast("array<long>")), lambda b: b < F.col("key"))
    spot = keys.join(F.broadcast(bounds), "curve").select("curve", "rep", F.size(below).alias("window"))

    n_asks = queries.select("rep").distinct().count()
    row_parts = max(1, -(-n_rows // (windows * unit)))
    ask_parts = max(1, -(-3 * n_asks // (windows * unit)))

    def salts(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    spots = distinct.join(spot, "rep")
    given = spots.select("curve", "window", F.pmod(F.xxhash64("rep"), F.lit(row_parts)).cast("int").alias("part"),
                         salts(ask_parts).alias("ask"), "rep", "embedding", F.lit(False).alias("asks"))
    asked = (spots.join(queries.select("rep").distinct(), "rep", "left_semi")
             .select("curve", F.explode(F.array(*[F.col("window") + d for d in (-1, 0, 1)])).alias("window"),
                     F.pmod(F.xxhash64(F.lit(1), "rep"), F.lit(ask_parts)).cast("int").alias("ask"), "rep", "embedding")
             .where(F.col("window").between(0, windows - 1))
             .select("curve", "window", salts(row_parts).alias("part"), "ask", "rep", "embedding",
                     F.lit(True).alias("asks")))
    near = (given.unionByName(asked).groupBy("curve", "window", "part", "ask")
            .applyInPandas(_nearest(k + 1), "asker long, rep long, score double"))
    by_asker = Window.partitionBy("asker").orderBy("score", "rep")
    best = (near.groupBy("asker", "rep").agg(F.min("score").alias("score"))
            .withColumn("i", F.row_number().over(by_asker)).where(F.col("i") <= k + 1))
    # the first k + 1 rows of each list: at most (k + 1) ** 2 members of k + 1 vectors
    lists = (best.join(members, "rep").groupBy("asker")
             .agg(F.slice(F.array_sort(F.flatten(F.collect_list(F.transform(
                 "ids", lambda v: F.struct(F.col("score"), v.alias("vec_id")))))), 1, 2 * k + 2).alias("found")))
    return (queries.select(F.col("vec_id").alias("query_id"), F.col("rep").alias("asker")).distinct().join(lists, "asker")
            .select("query_id", F.posexplode(F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k))
                    .alias("rank", "row"))
            .select("query_id", (F.col("rank") + 1).alias("rank"), F.col("row.vec_id").alias("vec_id"),
                    F.col("row.score").alias("score")))
