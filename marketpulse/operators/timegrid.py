"""Hourly grid (G1, P14) and the closed-interval bucket join.

A post at time ``ts`` belongs to every bucket ``[start, end]`` that contains
it; with both ends closed a post exactly on a grid point lands in two
buckets. Instead of a theta join against the grid (a nested-loop join, cost
posts x buckets), the bucket number is computed arithmetically and exploded:
map-side only, no shuffle, no broadcast, linear in the posts.

With ``a`` the first start, ``w`` the width and ``N`` the bucket count
(bucket ``j`` = ``[a + (j-1)w, a + jw]``), for ``d = ts - a`` in microseconds:
``d mod w != 0`` -> bucket ``d div w + 1``; ``d mod w == 0`` -> buckets
``d div w`` and ``d div w + 1``; only ``1 <= j <= N`` are kept.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketpulse.functions.columns import epoch_micros, floor_to

CLOSED_MODES = ("both", "right", "left")

# The grid of the original gold build, hourly starts from
# 2021-12-02 01:30 up to 2021-12-30 (inclusive range), each bucket one hour.
REFERENCE_GRID_START = "2021-12-02 01:30:00"
REFERENCE_GRID_END = "2021-12-30 00:00:00"


def _ntz_lit(value: datetime):
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


@dataclass(frozen=True)
class HourGrid:
    """Regular grid: ``count`` buckets of ``width`` starting at ``first_start``."""

    first_start: datetime
    width: timedelta
    count: int

    @classmethod
    def from_range(cls, start, end, width: timedelta = timedelta(hours=1)) -> "HourGrid":
        """Starts from ``start`` to ``end`` inclusive, like a date-range generator."""
        start = datetime.fromisoformat(start) if isinstance(start, str) else start
        end = datetime.fromisoformat(end) if isinstance(end, str) else end
        n = 0 if end < start else (end - start) // width + 1
        return cls(start, width, n)

    @classmethod
    def reference(cls) -> "HourGrid":
        return cls.from_range(REFERENCE_GRID_START, REFERENCE_GRID_END)

    @property
    def end(self) -> datetime:
        """End of the last bucket."""
        return self.first_start + self.width * self.count

    @property
    def width_micros(self) -> int:
        return self.width // timedelta(microseconds=1)

    def frame(self, spark: SparkSession) -> DataFrame:
        """``(bucket, startdatetime, enddatetime)``, generated on executors."""
        w = self.width_micros
        a = _ntz_lit(self.first_start)
        parts = max(1, self.count // 1_000_000 + 1)
        return spark.range(1, self.count + 1, 1, parts).select(
            F.col("id").alias("bucket"),
            F.timestamp_add("MICROSECOND", (F.col("id") - 1) * F.lit(w), a).alias("startdatetime"),
            F.timestamp_add("MICROSECOND", F.col("id") * F.lit(w), a).alias("enddatetime"),
        )


def bucket_assign(df: DataFrame, ts_col: str, grid: HourGrid, closed: str = "both",
                  start_col: str = "startdatetime", end_col: str = "enddatetime",
                  bucket_col: str | None = None) -> DataFrame:
    """Arithmetic form of the interval join: adds the bucket bounds, one row per match.

    ``closed``: "both" (the original semantics), "right" = (start, end],
    "left" = [start, end). Rows outside the grid or with NULL time are dropped.
    """
    if closed not in CLOSED_MODES:
        raise ValueError(f"closed must be one of {CLOSED_MODES}")
    w, n = grid.width_micros, grid.count
    a = _ntz_lit(grid.first_start)
    a_micros = (grid.first_start - datetime(1970, 1, 1)) // timedelta(microseconds=1)
    d, q, r, j = "_mp_d", "_mp_q", "_mp_r", "_mp_j"
    # plain comparisons on the time column reach the scan (row-group skipping)
    in_grid = F.col(ts_col).between(a, _ntz_lit(grid.first_start + grid.width * n))
    staged = (df.where(in_grid)
                .withColumn(d, epoch_micros(ts_col) - F.lit(a_micros))
                .where(F.col(d).between(0, n * w))
                .withColumn(q, F.expr(f"{d} div {w}"))
                .withColumn(r, F.expr(f"{d} % {w}")))
    on_edge = F.col(r) == 0
    nxt = F.col(q) + 1
    if closed == "both":
        js = F.when(on_edge, F.array(F.col(q), nxt)).otherwise(F.array(nxt))
    elif closed == "right":
        js = F.when(on_edge, F.array(F.col(q))).otherwise(F.array(nxt))
    else:
        js = F.array(nxt)
    out = (staged.withColumn(j, F.explode(js))
                 .where(F.col(j).between(1, n))
                 .withColumn(start_col, F.timestamp_add("MICROSECOND", (F.col(j) - 1) * F.lit(w), a))
                 .withColumn(end_col, F.timestamp_add("MICROSECOND", F.col(j) * F.lit(w), a)))
    if bucket_col:
        out = out.withColumnRenamed(j, bucket_col)
    return out.drop(d, q, r, j)


def bucket_join_theta(df: DataFrame, ts_col: str, grid_frame: DataFrame) -> DataFrame:
    """Literal theta-join form ``start <= ts <= end`` against a grid frame.

    Plans as a broadcast nested-loop join (posts x buckets); kept as the
    executable specification for equivalence tests and the benchmark.
    """
    g = grid_frame.select("startdatetime", "enddatetime")
    ts = F.col(ts_col)
    return df.join(g, (ts >= g["startdatetime"]) & (ts <= g["enddatetime"]), "inner")


def span_grid(df: DataFrame, ts_col: str, anchor_minutes: int = 30,
              width: timedelta = timedelta(hours=1)) -> DataFrame:
    """Grid spanning the data, on ``hh:<anchor>`` points (generated in Spark).

    First start = start of the hour of the earliest event + anchor, last
    start = same for the latest event; ``(bucket, startdatetime, enddatetime)``.
    """
    w = width // timedelta(microseconds=1)
    offset = int(anchor_minutes) * 60_000_000
    step = F.make_dt_interval(secs=F.lit(w // 1_000_000))

    def point(c):
        return F.timestamp_add("MICROSECOND", F.lit(offset), floor_to(c, 3_600_000_000))

    bounds = df.agg(point(F.min(ts_col)).alias("lo"), point(F.max(ts_col)).alias("hi"))
    # two levels, days (spread over tasks) and then the points of a day, so no row holds the whole grid
    per_day = max(1, 86_400_000_000 // w)
    stretch = F.timestamp_add("MICROSECOND", F.lit((per_day - 1) * w), F.col("d"))
    days = (bounds.where(F.col("lo").isNotNull())
            .select("lo", "hi", F.explode(F.sequence("lo", "hi", F.make_dt_interval(secs=F.lit(per_day * w // 1_000_000))))
                    .alias("d")).hint("rebalance"))
    return (days.select("lo", F.explode(F.sequence("d", F.least(stretch, "hi"), step)).alias("startdatetime"))
            .select((F.floor((epoch_micros("startdatetime") - epoch_micros("lo")) / F.lit(w)) + 1).alias("bucket"),
                    "startdatetime", F.timestamp_add("MICROSECOND", F.lit(w), F.col("startdatetime")).alias("enddatetime")))
