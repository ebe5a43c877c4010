"""Exact and near duplicates, repeats, mixing."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketpulse.llm import components, exact_dedup, mixing, queries, simhash, suffix_dedup
from tests.llm.helpers import (
    SF, duck, key, no_docs, odd_docs, odd_rows, repeats, rows_of, simhash as slow_simhash, simhash_groups,
)


@pytest.mark.parametrize("runs,fan_in", [(64, 8), (5, 2), (1, 2)])
def test_exact_dedup_odd_rows(spark, runs, fan_in):
    got = exact_dedup.exact_dedup(odd_docs(spark), runs=runs, fan_in=fan_in)
    names, want = duck(exact_dedup.ORACLE, odd_rows())
    columns = [c for c in names if c != "kept"]
    assert rows_of(got, *columns) == key(tuple(r[names.index(c)] for c in columns) for r in want)
    # exactly one row of each group stays, also of rows alike in text and id
    kept = got.groupBy("text_sha256").agg(F.sum(F.col("kept").cast("int")).alias("n")).select("n").distinct().collect()
    assert [r.n for r in kept] == [1]
    assert exact_dedup.exact_dedup(no_docs(spark)).count() == 0


def test_mixing_odd_rows(spark):
    names, want = duck(mixing.ORACLE, odd_rows())
    got = mixing.mix(odd_docs(spark))
    assert rows_of(got, *names) == key(want)
    assert mixing.mix(no_docs(spark)).count() == 0
    assert {tuple(r) for r in mixing.mix(spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string"))
            .select("size", "target", "taken").collect()} == {(0, 0.0, 0)}


@pytest.mark.parametrize("block,shard_docs", [(1, 3), (7, 5), (32, 1000)])
def test_mixing_targets_and_limits(spark, block, shard_docs):
    docs = spark.createDataFrame([(i, "w " * (i * 37 % 200), f"s{min(i % 11, 5)}") for i in range(400)],
                                 "doc_id long, text string, source string")
    rows = mixing.mix(docs, block=block, shard_docs=shard_docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    total = sum(r.size for r in rows)
    shards = -(-len(rows) // shard_docs)
    by = {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        by.setdefault(r.source, [0, r.target, r.source_size])[0] += r.taken
    for taken, target, size in by.values():
        assert abs(taken - target) <= block * (shards + 1) and target <= 2 * size + 1e-9
    assert sum(t for _, t, _ in by.values()) == pytest.approx(1.5 * total)


def test_mixing_several_shards_as_stated_in_sql(spark):
    """Three shards and sources of different numbers of them: the whole table of sf0.1 row by row."""
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.1/documents.parquet')")
    names = [d[0] for d in con.execute(mixing.ORACLE).description]
    got = mixing.mix(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    assert rows_of(got, *names) == key(con.execute(mixing.ORACLE).fetchall())


def thin_sources(spark):
    """600 documents of 4 words, target twice their size, and 200 of 5 words, target once, beside 8,000 others."""
    rows = [(i, "a b c d", "a") for i in range(600)] + [(i, "w " * 10, "b") for i in range(1000, 9000)]
    return spark.createDataFrame(rows + [(i, "a b c d e", "c") for i in range(10_000, 10_200)],
                                 "doc_id long, text string, source string")


@pytest.mark.parametrize("shard_docs", [4, 40, 100_000])
def test_mixing_short_documents_in_many_shards(spark, shard_docs):
    """What a source takes does not depend on how many shards its documents are spread over."""
    docs = thin_sources(spark)
    got = (mixing.mix(docs, weights=(3, 2, 1), shard_docs=shard_docs).join(docs.select("doc_id", "source"), "doc_id")
           .groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"),
                                  F.min(F.col("taken") / F.col("size")).alias("least")).collect())
    by = {r.source: r for r in got}
    assert by["a"].target == 4800 and by["a"].taken == 4800 and by["a"].least == 2
    for r in got:
        assert abs(r.taken - r.target) <= mixing.BLOCK


def test_mixing_trimmed_words_go_to_other_shards(spark):
    """A long document beside short ones: their shards win no block or more than they can take."""
    docs = spark.createDataFrame([(i, "w " * (3000 if i == 7 else 3), "a") for i in range(1000)]
                                 + [(i, "w " * 10, "b") for i in range(1000, 9000)], "doc_id long, text string, source string")
    got = mixing.mix(docs, shard_docs=40).where("doc_id < 1000").agg(F.sum("taken"), F.first("target")).first()
    assert got[1] == 2 * (3000 + 999 * 3) and abs(got[0] - got[1]) <= mixing.BLOCK


@pytest.mark.parametrize("long_ids", [True, False])
def test_repeats_blocks_hold_equal_bytes(spark, long_ids):
    """Long texts in one id range, or without id, do not make a block much larger than the others."""
    rows = [(i, f"{i:05d} " + "s" * 94) for i in range(5000)]
    rows += [(10_000 + i if long_ids else None, f"{i:05d} " + "l" * 199_994) for i in range(50)]
    docs = spark.createDataFrame(rows, "id long, text string").repartition(4)
    keyed = docs.select(F.coalesce("id", F.lit(0)).alias("doc_id"), F.col("id").isNull().alias("no_id"), "text",
                        F.substring("text", 1, suffix_dedup.TIE_CHARS).alias("head"), F.xxhash64("text").alias("tie"))
    size = sum(len(t) + 64 for _, t in rows)
    starts = suffix_dedup.block_starts(keyed, 55, size)
    assert 45 <= len(starts) < 55 and starts == sorted(starts)
    keys = sorted((bool(r.no_id), r.doc_id, r.head, r.tie, len(r.text)) for r in keyed.collect())
    held = [0] * (len(starts) + 1)
    for k in keys:
        held[__import__("bisect").bisect_right(starts, k[:4])] += k[4] + 64
    assert max(held) <= 2 * size / 55 and sum(held) == size


def test_sainte_lague_is_highest_quotients(spark):
    rng = np.random.default_rng(3)
    rows = [(g, p, int(v), int(s)) for g, (n, s) in enumerate([(1, 5), (4, 3), (9, 100), (30, 11), (6, 0), (5, 10_000)])
            for p, v in enumerate(rng.integers(0, 1000, n))]
    got = mixing.sainte_lague(spark.createDataFrame(rows, "g int, p int, v long, s long"), ["g"], ["p"], "v", "s")
    for g in {r[0] for r in rows}:
        parties = [(p, v) for h, p, v, _ in rows if h == g]
        seats = next(s for h, _, _, s in rows if h == g)
        won = dict.fromkeys([p for p, _ in parties], 0)
        for _ in range(seats):
            best = max(parties, key=lambda x: (x[1] / (2 * won[x[0]] + 1), -x[0]))
            won[best[0]] += 1
        assert {r.p: r.quota for r in got.where(f"g = {g}").collect()} == won


def test_fingerprints_match_definition():
    texts = [r[1] or "" for r in odd_rows()]
    assert simhash.fingerprints([t.encode() for t in texts]).tolist() == [slow_simhash(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2 ** 64 - 1), st.sets(st.integers(0, 63), max_size=2))
def test_partners_meet_at_the_home_anchor(x, bits):
    """Whatever two bits differ, the partner is replicated to the home anchor, once."""
    y = x
    for b in bits:
        y ^= 1 << b
    home = simhash.home_anchors(np.array([x], np.uint64))[0]
    _, near = simhash.near_anchors(np.array([y], np.uint64))
    assert (near == home).sum() == 1 and len(set(near.tolist())) == len(near)


def test_components_of_dense_near_copies(spark):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2 ** 64, 6, dtype=np.uint64)
    prints = {int(c) for c in centres}
    for c in centres[:3].tolist():  # balls, and a chain of single bits
        for _ in range(60):
            prints.add(c ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 4), replace=False)))
    x = int(centres[3])
    for b in range(40):
        x ^= 1 << b
        prints.add(x)
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    links = simhash.links(spark.createDataFrame([(s,) for s in signed], "fingerprint long"))
    want = {(signed[i], signed[j]) for i in range(len(prints)) for j in range(len(prints))
            if signed[i] < signed[j] and (prints[i] ^ prints[j]).bit_count() <= 2}
    got = [tuple(r) for r in links.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    part = {r.node: r.component for r in components.connected_components(links).collect()}
    slow = simhash_groups(prints)
    same = {}
    for p, s, g in zip(prints, signed, slow):
        same.setdefault(g, set()).add(part.get(s, s))
    assert all(len(v) == 1 for v in same.values()) and len({v.pop() for v in same.values()}) == len(set(slow))


def test_simhash_odd_rows(spark):
    rows = odd_rows()
    prints = [slow_simhash(r[1]) for r in rows]
    groups = simhash_groups(prints)
    least = {}
    for g, r in zip(groups, rows):
        if r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    want = key((r[0], f"{p:016x}", least.get(g)) for r, p, g in zip(rows, prints, groups))
    got = simhash.simhash_components(odd_docs(spark))
    assert rows_of(got, "doc_id", "fingerprint", "component_id") == want
    assert simhash.simhash_components(no_docs(spark)).count() == 0


def test_components_empty_and_path(spark):
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
    path = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(5, 5), (1, 0)], "u long, v long")
    got = {tuple(r) for r in components.connected_components(path).collect()}
    assert got == {(i, 0) for i in range(201)}


@pytest.mark.parametrize("block_bytes", [400, 3000, 1 << 22])
def test_repeats_odd_rows(spark, block_bytes):
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    got = suffix_dedup.remove_repeats(odd_docs(spark), block_bytes=block_bytes, range_bytes=block_bytes)
    assert rows_of(got, *columns) == repeats([r[:2] for r in odd_rows()])
    if block_bytes > 3000:
        assert suffix_dedup.remove_repeats(no_docs(spark)).count() == 0


def test_repeats_long_and_periodic_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 700)
    rng = np.random.default_rng(8)
    noise = "".join(rng.choice(list("abcdefgh "), 3000))
    rows = [(1, noise), (2, "q" * 50 + noise[300:2500] + "r"), (3, "xyz" * 500), (4, "yzx" * 90), (5, noise[:99]),
            (6, noise[1000:1100]), (7, "é" * 80 + noise[:150]), (8, "é" * 80)]
    texts = [t.encode() for _, t in rows]
    # chunks are local to a worker's module copy, so the whole block is run here
    first, last, name, cover = suffix_dedup.anchors(texts)
    joined = b"".join(texts)
    ends = np.cumsum([len(t) for t in texts])
    ruled = sorted(s for a, b in zip(first.tolist(), last.tolist()) for s in range(a, b + 1))
    want = sorted(s for t, e in zip(texts, ends.tolist()) for s in range(e - len(t), e - 99))
    assert ruled == want  # every window has exactly one anchor
    same = {}
    for a, b, n, c in zip(first.tolist(), last.tolist(), name.tolist(), cover.tolist()):
        assert same.setdefault((n, c), joined[a:b + 100]) == joined[a:b + 100]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=1000, range_bytes=500)
    assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == repeats(rows)


@pytest.mark.parametrize("name", ["op6_sainte_lague_mix", "op8_exact_dedup"])
def test_query_matches_oracle(spark, name):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    names, want = duck(queries.ORACLE[name], docs)
    assert rows_of(queries.QUERIES[name](spark, SF), *names) == key(want)


def test_near_dedup_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    groups = simhash_groups([slow_simhash(r.text) for r in docs])
    least = {}
    for g, r in zip(groups, docs):
        least[g] = min(least.get(g, r.doc_id), r.doc_id)
    assert rows_of(queries.op10_simhash_anchors(spark, SF), "doc_id", "component_id") == key(
        (r.doc_id, least[g]) for r, g in zip(docs, groups))


def test_repeats_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(queries.op4_suffix_dedup(spark, SF), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == repeats(
        [tuple(r) for r in docs])
