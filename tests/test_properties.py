"""Property tests: Spark operators against plain-Python brute force."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketpulse.operators.page_cap import cap_pages
from marketpulse.operators.timegrid import HourGrid, bucket_assign

SETTINGS = dict(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
BASE = datetime(2024, 3, 9, 22, 30)


def brute_buckets(ts, start, width, count, closed):
    out = []
    for j in range(1, count + 1):
        lo, hi = start + (j - 1) * width, start + j * width
        inside = {"both": lo <= ts <= hi, "right": lo < ts <= hi, "left": lo <= ts < hi}[closed]
        if inside:
            out.append(j)
    return out


@settings(**SETTINGS)
@given(width_min=st.sampled_from([1, 7, 30, 60, 90]), count=st.integers(1, 30),
       offsets=st.lists(st.integers(-200, 3000), min_size=1, max_size=40),
       on_grid=st.lists(st.integers(-1, 31), max_size=10),
       closed=st.sampled_from(["both", "right", "left"]))
def test_bucket_assign_matches_brute_force(spark, width_min, count, offsets, on_grid, closed):
    width = timedelta(minutes=width_min)
    grid = HourGrid(BASE, width, count)
    times = [BASE + timedelta(seconds=o * 17, microseconds=o % 7) for o in offsets]
    times += [BASE + k * width for k in on_grid]  # exact grid points
    rows = [(i, t.isoformat(sep=" ")) for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "id long, s string").select("id", F.col("s").cast("timestamp_ntz").alias("ts"))
    got = sorted((r.id, r.b) for r in bucket_assign(df, "ts", grid, closed=closed, bucket_col="b").collect())
    want = sorted((i, j) for i, t in enumerate(times) for j in brute_buckets(t, BASE, width, count, closed))
    assert got == want


@settings(**SETTINGS)
@given(sizes=st.dictionaries(st.sampled_from(["A", "B", "C"]),
                             st.lists(st.sampled_from([0, 1, 2, 5, 50, 99, 100]), min_size=1, max_size=25),
                             min_size=1),
       cap=st.sampled_from([1, 3, 100, 150]))
def test_cap_pages_matches_loop(spark, sizes, cap):
    rows = [(k, p, n) for k, ns in sizes.items() for p, n in enumerate(ns)]
    df = spark.createDataFrame(rows, "ticker string, page long, result_count long")
    got = sorted((r.ticker, r.page, r.rows_before) for r in cap_pages(df, cap).collect())
    want = []
    for k, ns in sizes.items():
        taken = 0
        for p, n in enumerate(ns):
            if taken >= cap:
                break
            if n > 0:
                want.append((k, p, taken))
            taken += n
    assert got == sorted(want)


def brute_merge(target, source):
    """Plain-Python MERGE: keys (k1, k2); update v1, v2 when any differs (SQL <>)."""
    def differs(a, b):
        return a is not None and b is not None and a != b
    out, matched = [], set()
    for t in target:
        hits = [s for s in source if s[0] is not None and s[1] is not None and (s[0], s[1]) == (t[0], t[1])]
        if hits:
            matched.add((t[0], t[1]))
            s = hits[0]
            if differs(t[2], s[2]) or differs(t[3], s[3]):
                out.append((t[0], t[1], s[2], s[3], t[4], "update"))
                continue
        out.append((*t, "copy"))
    for s in source:
        if s[0] is None or s[1] is None or (s[0], s[1]) not in matched:
            out.append((*s, "insert"))
    return sorted(out, key=repr)


@settings(**SETTINGS)
@given(t_keys=st.lists(st.tuples(st.integers(0, 6), st.sampled_from(["A", "B"])), unique=True, max_size=10),
       s_keys=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 8)), st.sampled_from(["A", "B"])),
                       unique=True, max_size=8),
       vals=st.lists(st.one_of(st.none(), st.integers(0, 2)), min_size=40, max_size=40))
def test_upsert_matches_brute_force(spark, t_keys, s_keys, vals):
    from marketpulse.operators.upsert import upsert_type1
    it = iter(vals)
    target = [(k1, k2, next(it), next(it), "t") for k1, k2 in t_keys]
    source = [(k1, k2, next(it), next(it), "s") for k1, k2 in s_keys]
    schema = "k1 int, k2 string, v1 int, v2 int, sector string"
    t = spark.createDataFrame(target, schema)
    s = spark.createDataFrame(source, schema)
    out = upsert_type1(t, s, ["k1", "k2"], ["v1", "v2"], ["k1", "k2", "v1", "v2", "sector"])
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    assert got == brute_merge(target, source)
