"""Small tables with every odd case, and brute-force versions of the operators."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import xxhash

SF = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}
# extra columns whose names the operators might use themselves
ODD_COLUMNS = ["row", "n", "size", "score", "block", "shard", "fingerprint", "kept", "run", "place", "digest"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"{c} string" for c in ODD_COLUMNS)
PASSAGE = "It was not until the third winter that anybody thought of asking the keeper of the lamp what he had seen. " * 2


def odd_rows():
    rows = [
        (1, "The quick brown fox jumps over the lazy dog. " + PASSAGE, "s1"),
        (2, "The quick brown  fox jumps over the lazy\ndog. " + PASSAGE, "s1"),
        (3, None, None), (4, "", ""), (5, " \t\n\x0b\x0c\r ", "s2"), (6, "one", "s2"), (7, "one two", "s2"),
        (8, "été naïve ΣΣ \U0001f600 café", "s3"), (8, "été naïve ΣΣ \U0001f600 café", "s3"),
        (9, "a" * 700, "s3"), (10, "ab" * 300 + PASSAGE, None), (11, "word " * 6000, "s4"),
        (None, "nobody knows my number " + PASSAGE, "s1"), (None, None, None), (-12, PASSAGE + "tail", "s1"),
        (13, "<|endoftext|> and <|startoftext|> are text, \x1f too.", "s5"), (14, "x, y. z,. w .v !.", "s5"),
    ]
    rows += [(100 + i, f"copy of a copy {i % 3} " + PASSAGE, "hot") for i in range(30)]
    return [(i, t, "en", s, len(t or ""), *["x"] * len(ODD_COLUMNS)) for i, t, s in rows]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def key(values):
    return sorted(values, key=repr)


def rows_of(df, *columns):
    return key(tuple(r) for r in df.select(*columns).collect())


def duck(sql, rows):
    """The oracle SQL over documents given as rows."""
    import pandas as pd

    con = duckdb.connect()
    frame = pd.DataFrame([r[:5] for r in rows], columns=["doc_id", "text", "lang", "source", "n_chars"])
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    con.register("documents", frame)
    out = con.execute(sql)
    names = [d[0] for d in out.description]
    return names, out.fetchall()


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w]


def simhash(text, shingle=3):
    w = words(text)
    if not w:
        return 0
    s = [" ".join(w)] if len(w) < shingle else [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def simhash_groups(prints, bits=2):
    """For each fingerprint the smallest one reachable."""
    u = sorted(set(prints))
    up = dict(zip(u, u))

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for i, a in enumerate(u):
        for b in u[:i]:
            if (a ^ b).bit_count() <= bits:
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return [find(p) for p in prints]


def repeats(rows, length=100):
    """(doc_id, n_bytes, n_removed, n_spans, kept sha256) by looking at every string."""
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            w = b[s:s + length]
            if w in seen:
                gone[s:s + length] = True
            seen.add(w)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return key(out)


def language_model(rows, weights_of):
    """(doc_id, held_out, n_tokens, n_known, N, base, score); ``weights_of`` maps EM cells to weights."""
    texts = [[*words(t), None] for _, t in rows]
    part = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 for i, _ in rows]
    one, two, one_d, two_d = Counter(), Counter(), Counter(), Counter()
    for t, m in zip(texts, part):
        if m != 2:
            one.update(t)
            two.update(zip([None, *t], t))
        if m == 5:
            one_d.update(t)
            two_d.update(zip([None, *t], t))
    n, v = sum(one.values()), len(one)
    kept, kept2 = one - one_d, two - two_d
    nk, vk = sum(kept.values()), len(kept)
    bucket = lambda c: int(math.log2(c + 1))
    cells = Counter()
    for t, m in zip(texts, part):
        if m == 5:
            for h, w in zip([None, *t], t):
                a = round(8 * math.log2(kept2[h, w] / kept[h] * (vk + 1))) if kept2[h, w] else -10_000
                b = round(8 * math.log2(kept[w] / nk * (vk + 1))) if kept[w] else -10_000
                cells[bucket(kept[h]), a, b] += 1
    weights = weights_of(np.array([(*k, c) for k, c in cells.items()], float).reshape(-1, 4))
    out = []
    for (i, _), t, m in zip(rows, texts, part):
        base = sum(math.log10((one[w] + 1) / (n + v + 1)) for w in t)
        score = 0.0
        for h, w in zip([None, *t], t):
            l2, l1, l0 = weights[bucket(one[h])]
            score += math.log10(l2 * (two[h, w] / one[h] if one[h] else 0) + l1 * one[w] / max(n, 1) + l0 / (v + 1))
        out.append((i, m == 2, len(t), sum(one[w] > 0 for w in t), n, base, score))
    return out
