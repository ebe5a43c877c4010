import json
import os
from datetime import datetime

from pyspark.sql import functions as F

from marketpulse.operators.aggregates import load_audit
from marketpulse.operators.page_cap import cap_pages
from marketpulse.sources.pages import flatten_pages, land_pages, page_meta, read_pages


def _post(i, t):
    return {"author_id": f"u{i}", "created_at": t, "id": str(i), "source": "web", "text": f"post {i}"}


def write_raw(root, ticker, page, doc):
    d = os.path.join(root, f"ticker={ticker}", f"page={page}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "response.json"), "w") as fh:
        json.dump(doc, fh, indent=2)  # pretty-printed, like a saved response


def test_raw_pages_edge_cases(spark, tmp_path_str):
    root = tmp_path_str + "/landing"
    # BAC: two pages of 60, the last without next_token; CAT: one empty page without data
    write_raw(root, "BAC", 0, {"data": [_post(i, "2021-12-02T14:30:00.000Z") for i in range(60)],
                               "meta": {"result_count": 60, "next_token": "t1"}})
    write_raw(root, "BAC", 1, {"data": [_post(i, "2021-12-02T15:30:00.000Z") for i in range(60, 120)],
                               "meta": {"result_count": 60}})
    write_raw(root, "CAT", 0, {"meta": {"result_count": 0}})
    pages = read_pages(spark, root, multiline=True)
    posts = flatten_pages(pages)
    assert posts.count() == 120
    assert posts.where("ticker = 'CAT'").count() == 0
    first = posts.where("id = '0'").first()
    assert first.created_at == datetime(2021, 12, 2, 14, 30) and first.user == "u0"
    meta = {(r.ticker, r.page): (r.result_count, r.is_last) for r in page_meta(pages).collect()}
    assert meta == {("BAC", 0): (60, False), ("BAC", 1): (60, True), ("CAT", 0): (0, True)}
    audit = {r.ticker: (r.post_count, r.total_posts, r.pages, r.complete) for r in load_audit(pages).collect()}
    assert audit == {"BAC": (120, 120, 2, True), "CAT": (0, 0, 1, True)}
    # page cap 100: the page that crosses the cap is kept whole
    capped = cap_pages(pages.select("ticker", "page", "data",
                                    F.col("meta.result_count").alias("result_count")), 100)
    assert sorted((r.ticker, r.page, r.rows_before) for r in capped.collect()) == [("BAC", 0, 0), ("BAC", 1, 60)]


def test_no_pages_at_all(spark, tmp_path_str):
    root = tmp_path_str + "/empty"
    os.makedirs(root)
    assert flatten_pages(read_pages(spark, root)).count() == 0


def brute_force_cap(sizes, cap):
    kept, taken = [], 0
    for page, n in sorted(sizes.items()):
        if taken >= cap:
            break
        kept.append((page, taken))
        taken += n
    return kept


def test_cap_pages_matches_loop(spark):
    import random
    rnd = random.Random(3)
    sizes = {k: {p: rnd.choice([0, 1, 5, 37, 100]) for p in range(60)} for k in ["A", "B", "C"]}
    rows = [(k, p, n) for k, d in sizes.items() for p, n in d.items()]
    df = spark.createDataFrame(rows, "ticker string, page long, result_count long")
    for cap in [1, 50, 100, 1000]:
        got = sorted((r.ticker, r.page, r.rows_before) for r in cap_pages(df, cap).collect())
        want = sorted((k, p, before) for k in sizes for p, before in brute_force_cap(sizes[k], cap)
                      if sizes[k][p] > 0)
        assert got == want, cap


def test_land_and_read_roundtrip(spark, tmp_path_str):
    rows = [(f"u{i}", f"2021-12-0{1 + i % 3} 1{i % 10}:00:00.{i:06d}", str(i), f"t{i}", "AB"[i % 2], i // 7)
            for i in range(40)]
    posts = spark.createDataFrame(rows, "user string, s string, id string, text string, ticker string, page long") \
        .select("user", F.col("s").cast("timestamp_ntz").alias("created_at"), "id", "text", "ticker", "page")
    for per_file in (False, True):
        root = f"{tmp_path_str}/land{per_file}"
        land_pages(posts, root, file_per_page=per_file)
        back = flatten_pages(read_pages(spark, root, multiline=per_file))
        assert back.select(*posts.columns).exceptAll(posts).count() == 0
        assert posts.exceptAll(back.select(*posts.columns)).count() == 0
        last = {r.ticker: r.page for r in page_meta(read_pages(spark, root, multiline=per_file))
                .where("is_last").collect()}
        assert last == {"A": 5, "B": 5}


def test_malformed_page_fails_unless_lenient(spark, tmp_path_str):
    import pytest
    root = tmp_path_str + "/bad"
    write_raw(root, "BAC", 0, {"data": [_post(1, "2021-12-02T14:30:00.000Z")], "meta": {"result_count": 1}})
    d = os.path.join(root, "ticker=BAC", "page=1")
    os.makedirs(d)
    with open(os.path.join(d, "response.json"), "w") as fh:
        fh.write('{"data": [ {"id": "2", "text": ')  # truncated response
    with pytest.raises(Exception):
        flatten_pages(read_pages(spark, root, multiline=True)).count()
    assert flatten_pages(read_pages(spark, root, multiline=True, strict=False)).count() == 1


def _posts(spark, n=40, width=7):
    rows = [(f"u{i}", "2021-12-02 10:00:00", str(i), f"t{i}", ["A", "B", None][i % 3], i // width) for i in range(n)]
    return spark.createDataFrame(rows, "user string, s string, id string, text string, ticker string, page long") \
        .select("user", F.col("s").cast("timestamp_ntz").alias("created_at"), "id", "text", "ticker", "page")


def test_runs_stay_apart_and_null_keys_stay(spark, tmp_path_str):
    root = tmp_path_str + "/runs"
    land_pages(_posts(spark), root, run="a")
    land_pages(_posts(spark, 20), root, run="b", closing_page=True)
    land_pages(_posts(spark, 20), root, run="b", closing_page=True)  # a repeated run replaces itself
    pages = read_pages(spark, root)
    assert flatten_pages(pages).groupBy("run").count().orderBy("run").collect() == [("a", 40), ("b", 20)]
    audit = {(r.run, r.ticker): (r.post_count, r.pages, r.complete) for r in load_audit(pages).collect()}
    assert audit[("a", None)] == (13, 6, True) and audit[("b", "A")] == (7, 4, True) and len(audit) == 6
    capped = cap_pages(pages.select("run", "ticker", "page", F.col("meta.result_count").alias("result_count")), 3)
    kept = {(r.run, r.ticker): [] for r in capped.collect()}
    for r in capped.collect():
        kept[r.run, r.ticker].append(r.page)
    # page 0 holds ids 0 to 6: three rows of A, two of each other key
    assert kept.keys() == audit.keys() and all(sorted(p) == ([0] if k == "A" else [0, 1]) for (_, k), p in kept.items())


def test_repeated_page_numbers_are_separate_pages(spark):
    rows = [("A", 1, 60, "x"), ("A", 1, 60, "y"), ("A", 2, 60, "z"), (None, 1, 60, "n")]
    df = spark.createDataFrame(rows, "ticker string, page long, result_count long, data string")
    got = cap_pages(df, 100).collect()
    assert sorted((r.ticker or "", r.page, r.rows_before) for r in got) == [("", 1, 0), ("A", 1, 0), ("A", 1, 60)]
    assert len({r.data for r in got}) == 3


def test_cap_does_not_depend_on_chunks(spark):
    rows = [("A", p, p % 4 * 25) for p in range(300)] + [("A", 10**9, 5)]
    df = spark.createDataFrame(rows, "ticker string, page long, result_count long")
    for cap in (1, 100, 1001, 5000, 10**9):
        want = [tuple(r) for r in cap_pages(df, cap, chunk_pages=10**6).orderBy("page").collect()]
        for size in (1, 7):
            assert [tuple(r) for r in cap_pages(df, cap, chunk_pages=size).orderBy("page").collect()] == want


def test_oversized_page_fails(spark, tmp_path_str, monkeypatch):
    import pytest

    import marketpulse.sources.pages as P
    monkeypatch.setattr(P, "MAX_PAGE_POSTS", 2)
    with pytest.raises(Exception, match="more than 2 posts"):
        land_pages(_posts(spark), tmp_path_str + "/big")
