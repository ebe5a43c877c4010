"""SimHash near-duplicates: links by anchors of a covering code, then components.

A fingerprint's first 46 bits are two words of 23 bits. The binary Golay code
covers every 23-bit word within 3 bits by exactly one codeword, so the pairs of
its codewords are 2^24 anchors, and each fingerprint has one home anchor. A
fingerprint is replicated to every anchor within covering radius plus
threshold: a partner at most t bits away differs from it in i and j bits of the
two words, i + j <= t, so it lies within 3 + i and 3 + j of the home anchor's
codewords. For t = 2 that is about 61 anchors a fingerprint. Homes meet replicas per
anchor, and the pairs are compared on all 64 bits. Every pair within the
threshold meets at the home of its smaller member, hence once and without loss.

All of this runs on distinct fingerprints: copies, however many, are one row, so
a fingerprint has at most 2,080 partners and links grow with the number of
distinct fingerprints, not with the square of a group's size.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketpulse.llm.common import cut, text_or_empty
from marketpulse.llm.components import connected_components
from marketpulse.llm.tokens import slices

SHINGLE = 3
MAX_BITS = 2
SEED = 42
# fixed value: generator polynomial of the binary Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
GOLAY = 0b101011100011
WORD_BITS = 23
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint (unsigned) of one text in UTF-8; 0 for a text without words."""
    return int(fingerprints([text], shingle)[0])


def fingerprints(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """Fingerprints (uint64): bit b is set if over half of the shingles' hashes have it."""
    from xxhash import xxh64_intdigest

    out = np.zeros(len(texts), np.uint64)
    todo: list[tuple[int, int]] = []
    hashes: list[int] = []

    def settle():
        if not todo:
            return
        h = np.array(hashes, dtype="<u8")
        n = np.array([n for _, n in todo])
        votes = np.zeros((len(todo), 64), np.int64)
        step = 1 << 16  # bits of so many shingles at a time
        owner = np.repeat(np.arange(len(todo)), n)
        for a in range(0, len(h), step):
            bits = np.unpackbits(h[a:a + step].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            first = np.flatnonzero(np.diff(owner[a:a + step], prepend=-1))
            votes[owner[a:a + step][first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
        won = np.packbits(2 * votes > n[:, None], axis=1, bitorder="little").view("<u8").ravel()
        out[[i for i, _ in todo]] = won
        todo.clear()
        hashes.clear()

    for i, text in enumerate(texts):
        words = text.translate(_LOWER).split()
        if not words:
            continue
        if len(words) <= shingle:
            hashes.append(xxh64_intdigest(b" ".join(words), SEED))
            todo.append((i, 1))
        else:
            joined = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words])
            starts = [0, *ends[:-1].tolist()]
            before = len(hashes)
            hashes += [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())]
            todo.append((i, len(hashes) - before))
        if len(hashes) > 1 << 16:
            settle()
    settle()
    return out


def with_fingerprint(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Adds ``fingerprint`` (signed 64-bit view)."""

    @F.pandas_udf("long")
    def udf(texts):
        import pandas as pd

        prints = [fingerprints([t.encode() for t in part], shingle) for _, part in slices(texts.tolist(), 1 << 20)]
        return pd.Series(np.concatenate([np.zeros(0, np.uint64), *prints]).view(np.int64))

    return docs.withColumn("fingerprint", udf(text_or_empty(text_col)))


@lru_cache
def _cosets(max_bits: int) -> list[np.ndarray]:
    """Per cost 0 .. max_bits: a row per syndrome of the error patterns leading to codewords.

    Cost 0 are patterns of weight <= 3 (one per syndrome), cost c those of weight
    3 + c. Rows are padded with -1.
    """
    remainder = []
    for i in range(WORD_BITS):
        r = 1 << i
        for b in range(WORD_BITS - 1, 10, -1):
            if r >> b & 1:
                r ^= GOLAY << (b - 11)
        remainder.append(r)
    rows = [[[] for _ in range(2048)] for _ in range(max_bits + 1)]
    for weight in range(3 + max_bits + 1):
        for bits in combinations(range(WORD_BITS), weight):
            syndrome = pattern = 0
            for b in bits:
                syndrome ^= remainder[b]
                pattern |= 1 << b
            rows[max(0, weight - 3)][syndrome].append(pattern)
    out = []
    for per in rows:
        table = np.full((2048, max(map(len, per))), -1, np.int64)
        for s, patterns in enumerate(per):
            table[s, :len(patterns)] = patterns
        out.append(table)
    # the syndromes of all words of 12 low and 11 high bits
    low, high = np.zeros(4096, np.int64), np.zeros(2048, np.int64)
    for i in range(WORD_BITS):
        part, at = (low, i) if i < 12 else (high, i - 12)
        part ^= np.where(np.arange(len(part)) >> at & 1, remainder[i], 0)
    return [*out, low, high]


def _halves(prints: np.ndarray, max_bits: int):
    *patterns, low, high = _cosets(max_bits)
    out = []
    for shift in (0, WORD_BITS):
        word = (prints >> np.uint64(shift)).astype(np.int64) & ((1 << WORD_BITS) - 1)
        out.append((word, low[word & 4095] ^ high[word >> 12]))
    return patterns, out


def home_anchors(prints: np.ndarray) -> np.ndarray:
    """The nearest anchor of each fingerprint (uint64)."""
    patterns, ((w1, s1), (w2, s2)) = _halves(prints, 0)
    return (w1 ^ patterns[0][s1, 0]) | (w2 ^ patterns[0][s2, 0]) << WORD_BITS


def near_anchors(prints: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """``(row, anchor)``: every anchor within covering radius plus threshold of each fingerprint."""
    patterns, ((w1, s1), (w2, s2)) = _halves(prints, max_bits)
    rows, anchors = [], []
    for c1 in range(max_bits + 1):
        for c2 in range(max_bits + 1 - c1):
            p1, p2 = patterns[c1][s1], patterns[c2][s2]
            at = (w1[:, None] ^ p1)[:, :, None] | (w2[:, None] ^ p2)[:, None, :] << WORD_BITS
            real = (p1 >= 0)[:, :, None] & (p2 >= 0)[:, None, :]
            rows.append(np.nonzero(real)[0])
            anchors.append(at[real])
    return np.concatenate(rows), np.concatenate(anchors)


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``u, v``: all pairs u < v of the distinct ``fingerprint`` rows within ``max_bits`` bits."""

    def homes(frames):
        import pandas as pd

        for f in frames:
            x = f["fingerprint"].to_numpy()
            yield pd.DataFrame({"anchor": home_anchors(x.view(np.uint64)), "u": x})

    def replicas(frames):
        import pandas as pd

        for f in frames:
            x = f["fingerprint"].to_numpy()
            for a in range(0, len(x), 2000):
                part = x[a:a + 2000]
                row, anchor = near_anchors(part.view(np.uint64), max_bits)
                yield pd.DataFrame({"anchor": anchor, "v": part[row]})

    left = prints.mapInPandas(homes, "anchor long, u long")
    right = prints.mapInPandas(replicas, "anchor long, v long")
    near = (F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits)
    return left.join(right, "anchor").where(near).select("u", "v")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                       max_bits: int = MAX_BITS, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint, component_id, group_id`` and the ``carry`` columns.

    ``fingerprint`` is 16 hex digits; ``component_id`` the smallest id reachable
    over links of at most ``max_bits`` differing bits; ``group_id`` is the
    component's smallest fingerprint, a number that also names components without ids. Null or empty text, or
    text of white space, has fingerprint zero and links like any other. Null ids
    never name a component unless it holds no other (then it is null). Repeated
    rows share a component; an empty table gives no rows; other columns are
    ignored.
    """
    rows = cut(with_fingerprint(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"), *carry),
                                "_text", shingle).drop("_text"))
    prints = cut(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    parts = connected_components(links(prints.select("fingerprint"), max_bits))
    named = prints.join(parts.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    named = named.withColumn("component", F.coalesce("component", "fingerprint"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").select("fingerprint", "component_id", F.col("component").alias("group_id"))
    return (rows.join(named, "fingerprint")
            .select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id",
                    "group_id", *carry))
