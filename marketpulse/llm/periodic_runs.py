"""Periodic runs of words by internal pattern matching over a suffix array.

A run is a maximal stretch of words with smallest period q that is long against
q. With exponent four or more, a run of period q in [B/2, B), B a power
of two, holds a whole block of B words that starts at a multiple of B, and
the block's next or previous occurrence lies exactly q away: two occurrences
closer than that would give a shorter period. So for every dyadic block the
occurrences in its neighbouring windows, an arithmetic progression, are
asked for, and the progression's difference is a candidate period:

* prefix doubling sorts the suffixes of a batch of documents (laid end to end,
  each word code its document's own, so nothing matches across documents). Its rounds
  rank blocks of 1, 2, 4 .. words; a round touches only suffixes not yet unique.
  A block's rank and group size are its interval of the suffix array.
* a wavelet matrix over the suffix array answers, for all blocks of a batch at
  once, the range successor and predecessor: the nearest position in the
  block's interval after and before the block.
* each candidate (position, period) is extended both ways by the ranks, which
  compare any two places by descending powers of two; stretches found
  more than once are kept with their smallest period.

Work and memory are proportional to n log n of a batch; a document of any length is
one batch at least. Documents never move between tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_WORDS = 1 << 17
EXPONENT = 4
MIN_WORDS = 6
SCHEMA = ("doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string, runs array<struct<start:long,length:long,period:long>>")


def block_ranks(codes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """``(suffix array, ranks, sizes)`` by prefix doubling.

    ``ranks[k][i]`` is the first suffix-array slot of the suffixes that agree
    with suffix i in 2^k words, ``sizes[k][slot]`` how many they are. Beyond
    the end every suffix is followed by something smaller than any word.
    """
    n = len(codes)
    order = np.argsort(codes)
    heads = np.flatnonzero(np.diff(codes[order], prepend=codes[order[0]] - 1))
    size = np.zeros(n, np.int32)
    size[heads] = np.diff(heads, append=n)
    rank = np.empty(n, np.int32)
    rank[order] = np.repeat(heads, size[heads])
    ranks, sizes, step = [rank], [size], 1
    live = order[size[rank[order]] > 1]
    while len(live):
        nxt = np.where(live + step < n, rank[np.minimum(live + step, n - 1)].astype(np.int64), -1)
        live = live[np.argsort(rank[live].astype(np.int64) * (n + 1) + nxt)]
        nxt = np.where(live + step < n, rank[np.minimum(live + step, n - 1)], -1)
        old = rank[live]
        first = np.flatnonzero(np.diff(old, prepend=-1))  # of each group of the round before
        slot = np.arange(len(live)) - np.repeat(first, np.diff(first, append=len(live))) + old
        split = np.flatnonzero((np.diff(old, prepend=-1) != 0) | (np.diff(nxt, prepend=-2) != 0))
        count = np.diff(split, append=len(live))
        rank, size = rank.copy(), size.copy()
        rank[live] = np.repeat(slot[split], count)
        size[slot[split]] = count
        ranks.append(rank)
        sizes.append(size)
        live = live[np.repeat(count, count) > 1]
        step *= 2
    suffixes = np.empty(n, np.int32)
    suffixes[rank] = np.arange(n, dtype=np.int32)
    return suffixes, ranks, sizes


class WaveletMatrix:
    """Range counting and selection by value over a sequence of numbers below ``2 ** bits``."""

    def __init__(self, values: np.ndarray):
        self.n, self.bits = len(values), max(1, int(len(values) - 1).bit_length())
        self.zeros, self.ranks = [], []
        for b in range(self.bits - 1, -1, -1):
            zero = (values >> b & 1) == 0
            upto = np.zeros(self.n + 1, np.int32)
            np.cumsum(zero, out=upto[1:])
            self.ranks.append(upto)
            self.zeros.append(int(upto[-1]))
            values = np.concatenate([values[zero], values[~zero]])

    def below(self, left: np.ndarray, right: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values in each slot range [left, right) are smaller than ``bound``."""
        a, b, found = left.copy(), right.copy(), np.zeros(len(left), np.int64)
        for level, (upto, zeros) in enumerate(zip(self.ranks, self.zeros)):
            za, zb = upto[a], upto[b]
            one = (bound >> (self.bits - 1 - level) & 1) == 1
            found += np.where(one, zb - za, 0)
            a, b = np.where(one, a - za + zeros, za), np.where(one, b - zb + zeros, zb)
        return np.where(bound >= self.n, right - left, found)

    def smallest(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The ``place``-th smallest value (from 0) in each slot range."""
        a, b, k, value = left.copy(), right.copy(), place.copy(), np.zeros(len(left), np.int64)
        for level, (upto, zeros) in enumerate(zip(self.ranks, self.zeros)):
            za, zb = upto[a], upto[b]
            one = k >= zb - za
            value += np.where(one, 1 << (self.bits - 1 - level), 0)
            k = np.where(one, k - (zb - za), k)
            a, b = np.where(one, a - za + zeros, za), np.where(one, b - zb + zeros, zb)
        return value


def _common(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray, back: bool) -> np.ndarray:
    """Words that agree from places a and b on (``back``: before them)."""
    n, a, b = len(ranks[0]), a.astype(np.int64), b.astype(np.int64)
    far = np.zeros(len(a), np.int64)
    top, k = len(ranks) - 1, np.full(len(a), len(ranks) - 1)
    todo = np.arange(len(a))
    while len(todo):  # the largest step is taken as often as it goes, each smaller one at most once
        x, y, level = a[todo], b[todo], k[todo]
        step = np.left_shift(1, level)
        if back:
            x, y = x - step, y - step
        inside = (x >= 0) & (y < n)
        same = np.zeros(len(todo), bool)
        for j in np.unique(level):
            at = inside & (level == j)
            same[at] = ranks[j][x[at]] == ranks[j][y[at]]
        moved = np.where(same, step, 0)
        far[todo] += moved
        sign = -1 if back else 1
        a[todo] += sign * moved
        b[todo] += sign * moved
        k[todo] = np.where(same & (level == top), top, level - 1)
        todo = todo[k[todo] >= 0]
    return far


def find_runs(codes: np.ndarray, exponent: int = EXPONENT, min_words: int = MIN_WORDS) -> np.ndarray:
    """Rows (start, length, period) of all runs of ``codes``, by start, then period."""
    none = np.empty((0, 3), np.int64)
    if len(codes) < min_words:
        return none
    suffixes, ranks, sizes = block_ranks(codes)
    blocks, left, right, width = [], [], [], []
    for k in range(1, len(ranks)):
        at = np.arange(0, len(codes) - (1 << k) + 1, 1 << k)
        slot = ranks[k][at]
        many = sizes[k][slot] > 1
        blocks.append(at[many])
        left.append(slot[many])
        right.append(slot[many] + sizes[k][slot[many]])
        width.append(np.full(int(many.sum()), 1 << k))
    if not blocks or not sum(map(len, blocks)):
        return none
    at, left, right, width = (np.concatenate(x).astype(np.int64) for x in (blocks, left, right, width))
    tree = WaveletMatrix(suffixes)
    before = tree.below(left, right, at)  # the block itself is the next one
    found = []
    for place, ok in ((before + 1, before + 1 < right - left), (before - 1, before > 0)):
        other = tree.smallest(left[ok], right[ok], place[ok])
        period = np.abs(other - at[ok])
        near = (period < width[ok]) & (2 * period >= width[ok])
        found.append(np.stack([np.minimum(other, at[ok])[near], period[near]], axis=1))
    pairs = np.unique(np.concatenate(found), axis=0)
    if not len(pairs):
        return none
    x, q = pairs[:, 0], pairs[:, 1]
    start = x - _common(ranks, x, x + q, True)
    length = x + _common(ranks, x, x + q, False) + q - start
    long = length >= np.maximum(min_words, exponent * q)
    rows = np.stack([start, length, q], axis=1)[long]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    smallest = np.ones(len(rows), bool)
    smallest[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[smallest]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _document_rows(ids, texts, exponent, min_words, view):
    """The result rows of a batch of documents."""
    import pandas as pd

    words = [(t or "").encode().split() for t in texts]
    if view:
        for i, w in enumerate(words):
            index = view(ids[i], len(w))
            if index is not None:
                words[i] = [w[j] for j in index]
    sizes = np.array([len(w) for w in words])
    flat, _ = pd.factorize(np.array([x for w in words for x in w] or [b""], object))
    flat = flat[:sizes.sum()]
    doc = np.repeat(np.arange(len(words)), sizes)
    # a word's code is its document's own; an end that occurs once stands after each document
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    codes = np.arange(sizes.sum() + len(words), dtype=np.int64)
    inner = np.ones(len(codes), bool)
    inner[starts + sizes] = False
    codes[inner] = len(codes) + doc * (int(flat.max(initial=0)) + 1) + flat
    runs = find_runs(codes, exponent, min_words)
    owner = np.searchsorted(starts, runs[:, 0], "right") - 1
    runs[:, 0] -= starts[owner]
    edges = np.searchsorted(owner, np.arange(len(words) + 1))
    out = []
    for i, w in enumerate(words):
        mine = runs[edges[i]:edges[i + 1]]
        best, kept = (None,) * 4, w
        if len(mine):
            s, n, q = mine[np.lexsort((mine[:, 2], mine[:, 0], -mine[:, 1]))[0]].tolist()
            best = (s, n, q, 1000 * n // q)
            inside = np.zeros(len(w) + 1, np.int64)
            np.add.at(inside, mine[:, 0] + mine[:, 2], 1)
            np.add.at(inside, mine[:, 0] + mine[:, 1], -1)
            kept = [w[j] for j in np.flatnonzero(np.cumsum(inside[:-1]) == 0)]
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in mine.tolist())
        out.append((ids[i], len(w), len(mine), *best, hashlib.sha256(listed.encode()).hexdigest(),
                    hashlib.sha256(b" ".join(kept)).hexdigest(),
                    [{"start": s, "length": n, "period": q} for s, n, q in mine.tolist()]))
    return out


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", exponent: int = EXPONENT,
                  min_words: int = MIN_WORDS, view: Callable[[int | None, int], np.ndarray | None] | None = None) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_runs``, its longest run, digests and all ``runs``.

    A run is a stretch of words (separated by ASCII white space) with smallest period q and
    ``length >= max(min_words, exponent * q)`` that no neighbouring word extends. The
    longest run has ``start, length, period, exponent_milli`` (ties: smallest start, then period; null without runs).
    ``runs_sha256`` digests the lines ``start,length,period`` of all runs; ``collapsed_sha256`` the
    words joined by blanks, without those that a run holds after its first period.
    ``view(doc_id, n)`` may give the word numbers a document is to be read as instead of its
    own words. ``exponent`` is four at least. Null and empty texts have no words;
    repeated rows and rows without id are documents of their own; extra columns are
    ignored; an empty table gives no rows.
    """
    if exponent < 4:
        raise ValueError("blocks find every run only from exponent four on")

    def run(frames):
        import pandas as pd

        names = [c.strip().split(" ")[0] for c in SCHEMA.split(", ")]
        for frame in frames:
            ids = [None if x is None else int(x) for x in frame["doc_id"]]
            texts = frame["text"].tolist()
            # batches by characters, about six a word; a longer document is a batch of its own
            n = np.cumsum([len(t or "") // 6 + 1 for t in texts])
            batch = n // BATCH_WORDS
            for a, b in zip(*(lambda e: (e, [*e[1:], len(texts)]))(np.flatnonzero(np.diff(batch, prepend=-1)).tolist())):
                rows = pd.DataFrame(_document_rows(ids[a:b], texts[a:b], exponent, min_words, view), columns=names)
                yield rows.astype({c: "Int64" for c in names[:7]})

    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, SCHEMA)


def planted_period(doc_id: int | None, n: int) -> np.ndarray | None:
    """Of one document in ten (by its id's crc32) the words from a place on repeat: a stand-in for broken generations."""
    import zlib

    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    index = np.arange(n)
    index[a:] = a + (index[a:] - a) % p
    return index
