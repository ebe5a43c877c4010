"""Line dedup, phrase mining and periodic runs against SQL or brute force."""

import hashlib
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketpulse.llm import collocations, line_dedup, periodic_runs, queries
from marketpulse.llm.packed import pack_counts, pack_keys
from tests.llm.helpers import LOWER, SF, key, no_docs, odd_docs, odd_rows, rows_of

SPACES = " \t\n\x0b\x0c\r"
LINE = "This footer stands below every page of the almanac, whoever prints it."


# ---------------------------------------------------------------- line dedup

def line_rows():
    rows = odd_rows()
    rows = [(*r[:1], None if r[1] is None else r[1] + (f"\n  {LINE}\t\n{r[1][:3]}\n{LINE.upper()}" if i % 3 else "\n"), *r[2:])
            for i, r in enumerate(rows)]
    odd = ["x" * 39, "x" * 40, "\xe9" * 40, " " + "y" * 40]
    rows += [(500 + i, "\n".join([*odd, f"line {i}", *odd]), "fr", "s1", 1, *rows[0][5:]) for i in range(7)]
    # a text of megabytes: many lines of its own, one shared, one repeated
    rows.append((900, "\n".join([LINE] + [f"{i} is the number of this long and lonely line of text" for i in range(60_000)] + [LINE]),
                 "en", None, 1, *rows[0][5:]))
    # rows without id, repeated ones among them
    rows += [(None, f"{LINE}\nrow {i % 2}", None, None, 1, *rows[0][5:]) for i in range(4)]
    return rows


def kept_lines(rows, min_chars=40, min_docs=5):
    def name(i, t):
        return (i, None) if i is not None else (None, t or "")

    def fold(line):
        return line.strip(SPACES).translate(LOWER)

    where = defaultdict(set)
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            if len(fold(line)) >= min_chars:
                where[fold(line)].add(name(i, t))
    out = []
    for i, t, *_ in rows:
        lines, stay = (t or "").split("\n"), []
        for line in lines:
            docs = where.get(fold(line), ())
            numbered = [d[0] for d in docs if d[0] is not None]
            goes = len(docs) >= min_docs and (i is None or i != max(numbered, default=None))
            if not goes or not numbered and i is None:
                stay.append(line)
        out.append((i, len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return key(out)


@pytest.mark.parametrize("min_docs", [2, 5])
def test_line_dedup_brute_force(spark, min_docs):
    rows = line_rows()
    docs = spark.createDataFrame(rows, odd_docs(spark).schema).repartition(5)
    got = line_dedup.line_bitmaps(docs, min_docs=min_docs, carry=("text",))
    kept = line_dedup.kept_text(F.coalesce("text", F.lit("")), F.col("keep_runs"))
    got = got.withColumn("kept_sha256", F.sha2(kept, 256))
    assert rows_of(got, "doc_id", "n_lines", "n_dropped", "kept_sha256") == kept_lines(rows, min_docs=min_docs)
    # a bitmap's ones are the lines that stay, in order and apart
    for r in got.collect():
        assert sum(s.length for s in r.keep_runs) == r.n_lines - r.n_dropped
        assert all(a.start + a.length < b.start for a, b in zip(r.keep_runs, r.keep_runs[1:]))
    assert line_dedup.line_bitmaps(no_docs(spark)).count() == 0


def test_line_dedup_among_rows_without_id(spark):
    """A line that only rows without id hold stays in one of their texts, in all its repeats."""
    rows = [(None, f"{LINE}\n{i % 6}", 1) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, keep_runs int")
    got = line_dedup.line_bitmaps(docs, carry=("text",)).where("n_dropped = 0").collect()
    assert len(got) == 2 and got[0].text == got[1].text


def test_line_dedup_moves_lines_once_and_without_python(spark, monkeypatch):
    plans = []

    def plan_only(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(line_dedup, "written", plan_only)
    line_dedup.line_bitmaps(spark.read.parquet(f"{SF}/documents.parquet"))
    lines, runs = plans
    assert "Exchange" not in lines and "Python" not in lines + runs
    assert "rangepartitioning" in runs and "Window" in runs and "hashpartitioning" not in runs


def test_line_dedup_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op11_line_dedup(spark, SF)
    assert rows_of(got, "doc_id", "n_lines", "n_dropped", "kept_sha256") == kept_lines(docs)


# ------------------------------------------------------------- phrase mining

def slow_phrases(rows, min_count, top):
    """All phrases of one to four words counted one by one."""
    count, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang] += len(w)
            for k in range(1, 5):
                count[lang].update(w[i:i + k] for i in range(len(w) - k + 1))
    out = []
    for lang, f in count.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        around = Counter()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    around[p[i:i + k]] = max(around[p[i:i + k]], a)
        found = []
        for p, a in candidates.items():
            if 100 * around[p] >= 80 * a:
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return key(out)


PHRASES = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def phrase_rows():
    rows = [(i, t, None if j % 3 == 0 else "en" if j % 2 else "fr", *r) for j, (i, t, _, *r) in enumerate(odd_rows())]
    extra = ["Once upon a time; once upon a time, UPON a time", "a a a a a a a", "New\tYork, new york. New\x1fYork new york city",
             "\x85 \xa0 \u2003 w", "x y z w" * 3]
    rows += [(800 + i, extra[i % len(extra)], ["en", "fr", None][i % 3], "s", 1, *rows[0][5:]) for i in range(45)]
    # a text of megabytes
    rows.append((990, "the keeper of the lamp " * 60_000 + "\n" + " ".join(f"w{i % 700} v{i % 11}" for i in range(90_000)), "en", None, 1,
                 *rows[0][5:]))
    return rows


@pytest.mark.parametrize("min_count,top,unit,dense", [(3, 10_000, None, 4), (5, 7, 200, 1 << 17), (2, 50, 60_000, 50)])
def test_phrases_brute_force(spark, min_count, top, unit, dense):
    rows = phrase_rows()
    docs = spark.createDataFrame(rows, odd_docs(spark).schema).repartition(4)
    got = collocations.phrases(docs, min_count=min_count, top=top, unit_bytes=unit, group_bytes=unit and 40 * unit, dense=dense)
    assert rows_of(got, *PHRASES) == slow_phrases(rows, min_count, top)
    assert collocations.phrases(no_docs(spark)).count() == 0


def test_phrase_scores_beyond_64_bits(spark):
    """The score of counts whose product with the scale passes 64 bits is exact."""
    a, left, right = 9_000_000_000_000_000_001, 9_100_000_000_000_000_003, 9_200_000_000_000_000_007
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    got = row.select(collocations._score(F.col("a"), F.col("l"), F.col("r"))).first()[0]
    assert got == 2_000_000 * a // (left + right)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12_000), st.integers(0, 12_000), st.integers(1, 9)), max_size=60), st.integers(1, 10))
def test_tiles_count_like_a_counter(pairs, dense):
    codes = np.array([a << 32 | b for a, b, _ in pairs], np.uint64)
    weights = np.array([w for *_, w in pairs], np.int64)
    for w in (None, weights):
        want = Counter()
        for c, x in zip(codes.tolist(), weights.tolist()):
            want[c] += 1 if w is None else x
        found, counts = collocations.count_tiles(codes, w, dense)
        assert list(zip(found.tolist(), counts.tolist())) == sorted(want.items())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=40), st.integers(1, 7))
def test_pairs_in_slices(ids, width):
    before, collocations.SLICE = collocations.SLICE, width
    try:
        ids = np.array([int(collocations.GONE) if i == 5 else i for i in ids], np.uint32)
        found, counts = collocations.count_pairs(ids)
    finally:
        collocations.SLICE = before
    want = Counter(int(a) << 32 | int(b) for a, b in zip(ids, ids[1:]) if collocations.GONE not in (a, b))
    assert list(zip(found.tolist(), counts.tolist())) == sorted(want.items())


def test_phrase_tasks_hold_a_unit_at_a_time():
    """What a task holds does not follow the units in its batch, and a group's sums stay near its pairs."""
    rng = np.random.default_rng(5)
    units = pd.DataFrame([(u, "en", rng.integers(0, 900, 4000).astype(np.uint32).tobytes()) for u in range(3)],
                         columns=["unit", "lang", "ids"])
    frames = list(collocations._request(7, 2, collocations.DENSE)(iter([units])))
    assert [sorted(set(f["unit"])) for f in frames] == [[0], [1], [2]]
    rows = [np.unique(rng.integers(0, 1 << 40, 15000).astype(np.uint64)) for _ in range(170)]
    asked = pd.DataFrame([(1, "en", u, pack_keys(k), pack_counts(np.ones(len(k), np.int64))) for u, k in enumerate(rows)],
                         columns=["part", "lang", "unit", "codes", "counts"])
    tracemalloc.start()
    try:
        found = pd.concat(collocations._merge(2, collocations.DENSE)(iter([asked])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    counts = np.unique(np.concatenate(rows), return_counts=True)[1]
    assert found["f"].sum() == counts[counts > 1].sum()
    assert peak < 80 * sum(map(len, rows))


def test_phrases_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]
    assert rows_of(queries.op12_collocations(spark, SF), *PHRASES) == slow_phrases(docs, 30, 2000)


# -------------------------------------------------------------- periodic runs

def slow_runs(c):
    """Every maximal stretch by comparing all words at every distance."""
    found = {}
    for q in range(1, len(c) // 4 + 1):
        i = 0
        while i + q < len(c):
            j = i
            while j + q < len(c) and c[j] == c[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def slow_periodic(doc_id, text, planted=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str("" if doc_id is None else doc_id).encode()), len(words)
    if planted and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = sorted(slow_runs(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


PERIODIC = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 30)), max_size=6))
def test_runs_of_any_sequence(parts):
    c = [x for unit, n in parts for x in (unit * (n // len(unit) + 1))[:n]]
    got = periodic_runs.find_runs(np.array(c, np.int64))
    assert sorted(map(tuple, got.tolist())) == slow_runs(c)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=80), st.data())
def test_wavelet_matrix(extra, data):
    values = np.array(data.draw(st.permutations(range(len(extra)))), np.int64)
    tree = periodic_runs.WaveletMatrix(values)
    left = data.draw(st.integers(0, len(values) - 1))
    right = data.draw(st.integers(left + 1, len(values)))
    bound = data.draw(st.integers(0, len(values) + 3))
    place = data.draw(st.integers(0, right - left - 1))
    as_array = [np.array([x]) for x in (left, right)]
    part = sorted(values[left:right].tolist())
    assert tree.below(*as_array, np.array([bound]))[0] == sum(v < bound for v in part)
    assert tree.smallest(*as_array, np.array([place]))[0] == part[place]


def test_periodic_runs_odd_rows(spark):
    rows = odd_rows() + [(700 + i, " ".join(["tick tock"] * 50 + [f"w{j}" for j in range(i)] + ["a b c d e f g"] * 9), "en", "s", 1,
                          *odd_rows()[0][5:]) for i in range(60)]
    docs = spark.createDataFrame(rows, odd_docs(spark).schema).repartition(3)
    got = periodic_runs.periodic_runs(docs, view=periodic_runs.planted_period)
    assert rows_of(got, *PERIODIC) == key(slow_periodic(*r[:2]) for r in rows)
    plain = periodic_runs.periodic_runs(docs)
    assert rows_of(plain, *PERIODIC) == key(slow_periodic(*r[:2], planted=False) for r in rows)
    assert all(len(r.runs) == r.n_runs for r in plain.select("runs", "n_runs").collect())
    assert periodic_runs.periodic_runs(no_docs(spark)).count() == 0


def test_periodic_run_in_a_text_of_megabytes(spark):
    unit = [f"u{i}" for i in range(9001)]
    words = [f"a{i}" for i in range(150_001)] + unit * 12 + unit[:17] + [f"z{i}" for i in range(1000)] + ["."] * 70_000
    got = periodic_runs.periodic_runs(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).first()
    assert [tuple(r) for r in got.runs] == [(150_001, 12 * 9001 + 17, 9001), (len(words) - 70_000, 70_000, 1)]
    assert (got.start, got.length, got.period, got.exponent_milli) == (150_001, 12 * 9001 + 17, 9001, 12_001)


def test_periodic_runs_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    short = [d for d in docs if len(d[1] or "") < 20_000]  # the slow version is quadratic
    got = {r.doc_id: tuple(r) for r in queries.op13_periodic_runs(spark, SF).select(*PERIODIC).collect()}
    assert len(got) == len(docs) and len(short) > 0.9 * len(docs)
    for d in short:
        assert got[d[0]] == slow_periodic(*d)
