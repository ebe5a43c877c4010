"""Cursor chains of landed pages against walking them."""

import random

import pytest
from pyspark.sql import functions as F

from marketpulse.operators.aggregates import load_audit
from marketpulse.operators.page_chain import chain_status
from marketpulse.sources.pages import land_pages, read_pages

SCHEMA = "run string, ticker string, page long, token string, meta struct<result_count:long,next_token:string>"


def walk(pages):
    """(chain pages, chain posts, problem, place, token) of one search by following the tokens."""
    by = {}
    for _, _, page, token, (posts, to) in sorted(pages, key=lambda p: (p[2], p[4][0] or 0)):
        by.setdefault(token or "", []).append((posts or 0, to))
    at, seen, posts, first = "", [], 0, None
    while True:
        if at in seen:
            first = first or ("loop", len(seen), at)
            break
        if at not in by:
            first = first or ("gap", len(seen), at)
            break
        seen.append(at)
        posts += by[at][0][0]
        nexts = {to for _, to in by[at]}
        if len(nexts) > 1:
            first = first or ("fork", len(seen) - 1, at)
            break
        if len(by[at]) > 1:
            first = first or ("repeat", len(seen) - 1, at)
        at = nexts.pop()
        if at is None:
            break
    return (len(seen), posts, *(first or (None, None, None)))


def chain(run, ticker, n, rnd, shuffled=False):
    order = list(range(n))
    if shuffled:
        rnd.shuffle(order)
    return [[run, ticker, order[i], f"t{i}" if i else None, (rnd.randint(0, 9), f"t{i + 1}" if i + 1 < n else None)] for i in range(n)]


def damage(pages, rnd):
    kind = rnd.choice(["none", "gap", "loop", "repeat", "fork", "self", "start", "end", "orphan"])
    i = rnd.randrange(len(pages))
    p = pages[i]
    if kind == "gap" and len(pages) > 1:
        del pages[i]
    elif kind == "loop":
        p[4] = (p[4][0], pages[rnd.randrange(len(pages))][3])
    elif kind == "self":
        p[4] = (p[4][0], p[3])
    elif kind == "repeat":
        pages.append([*p[:2], p[2] + 1000, *p[3:]])
    elif kind == "fork":
        pages.append([*p[:3], p[3], (5, rnd.choice([None, "t1", "nowhere"]))])
    elif kind == "start":
        pages[:] = [q for q in pages if q[3] is not None] or pages
    elif kind == "end":
        pages[-1][4] = (1, "beyond")
    elif kind == "orphan":
        pages.append([*p[:2], 5000, "x", (3, rnd.choice([None, "t1", "t2", "x"]))])


@pytest.mark.parametrize("chunk_pages", [1, 4, 1024])
def test_like_walking(spark, chunk_pages):
    rnd = random.Random(chunk_pages)
    searches = {}
    for k in range(120):
        run, ticker = rnd.choice(["r1", "r2", None]), rnd.choice([f"T{k}", f"T{k}", None]) if k else None
        pages = chain(run, ticker, rnd.randint(1, 23), rnd, shuffled=k % 3 == 0)
        for _ in range(rnd.randint(0, 3)):
            damage(pages, rnd)
        searches.setdefault((run, ticker), pages)
    rows = [tuple(p) for pages in searches.values() for p in pages]
    rnd.shuffle(rows)
    got = {(r.run, r.ticker): r for r in chain_status(spark.createDataFrame(rows, SCHEMA), chunk_pages).collect()}
    assert got.keys() == searches.keys()
    for key, pages in searches.items():
        r = got[key]
        assert (r.chain_pages, r.chain_posts, r.problem, r.problem_at, r.problem_token) == walk(pages), (key, pages)
        assert r.complete == (r.problem is None) and r.pages_landed == len(pages)


def test_no_pages(spark):
    assert chain_status(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_long_chain_out_of_order_takes_few_rounds(spark, monkeypatch):
    import marketpulse.operators.page_chain as C
    written = []
    real = C._written
    monkeypatch.setattr(C, "_written", lambda df, name: written.append(name) or real(df, name))
    pages = chain("r", "A", 300, random.Random(1), shuffled=True)
    row = chain_status(spark.createDataFrame([tuple(p) for p in pages], SCHEMA)).first()
    assert row.complete and row.chain_pages == 300
    assert written.count("chain-reached") <= 12


def test_lost_page_makes_the_audit_incomplete(spark, tmp_path_str):
    posts = spark.range(1000).select(F.col("id").cast("string").alias("user"), F.lit("2021-12-02 10:00:00").cast("timestamp_ntz")
                                     .alias("created_at"), F.col("id").cast("string").alias("id"), F.lit("t").alias("text"),
                                     F.lit("CAT").alias("ticker"), F.expr("id div 100 * 3").alias("page"))
    land_pages(posts, tmp_path_str, closing_page=True)
    pages = read_pages(spark, tmp_path_str)
    assert load_audit(pages).first().complete
    for lost in (0, 12, 28):
        row = load_audit(pages.where(F.col("page") != lost)).first()
        assert not row.complete and row.pages == 10


def test_pages_without_tokens_are_linked_by_number(spark):
    rows = [("r", "A", p, None, (1, None if p == 6 else f"n{p}")) for p in (3, 4, 5, 6)]
    assert chain_status(spark.createDataFrame(rows, SCHEMA)).first().complete
    row = chain_status(spark.createDataFrame(rows[:2] + rows[3:], SCHEMA).drop("token")).first()
    assert (row.problem, row.problem_at, row.problem_token, row.chain_posts) == ("gap", 2, "page 5", 2)
