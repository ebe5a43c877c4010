"""Repeated byte strings by prefix doubling over sampled positions.

A name of the 2^j bytes at a position is made from the pair of names, 2^(j-1) apart,
of half that length (1, 2, 4 .. 64 bytes), and of the 100 bytes at the threshold from two
overlapping names of 64. Names are 64-bit hashes, so the short rounds need no
exchange; the rounds that decide are Spark sorts of name pairs, and positions
whose name is unique leave after each:

1. Length 32, at sampled positions. Every window of 100 bytes is ruled by one
   anchor: its 32-byte string of the smallest name, the leftmost of equals. The
   anchor depends on the window's bytes alone, so equal windows have
   equal anchors at equal offsets, and about one position in 32 is an anchor.
   The windows an anchor rules are consecutive; the pair (name of the anchor, name
   of all bytes its windows cover) is sorted. Unique anchor names leave: none of
   their windows repeats. An anchor whose whole pair occurs earlier has all
   its windows repeated. First occurrences stay only if their anchor name also
   occurs with other surroundings.
2. Length 100: the single windows of those first occurrences, pairs of names
   36 apart, are sorted. A window whose name occurs earlier is repeated. A name
   is 64 bits and 32 bits of a second one made from other byte names.

Sorts go by request and reply: documents are dealt into blocks that follow
the order of ids; a block sends its distinct names to ranges of the name
space (a string however frequent is one entry per block) and gets one bit per entry
back: whether an earlier block has it. What repeats within a block the
block sees itself. No group of equal strings is ever together in one task.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketpulse.llm.common import exchange_size, released_shuffles, text_or_empty, written
from marketpulse.llm.packed import pack_keys, range_edges, unpack_keys
from marketpulse.session import scratch_path

LENGTH = 100
TIE_CHARS = 64
ORDER = ["no_id", "doc_id", "head", "tie"]  # of documents: id (null last), first characters, a hash of the text
SEED_LENGTH = 32  # anchors; half of 64, and 64 + 36 = LENGTH
BLOCK_BYTES = 4 << 20
RANGE_BYTES = 8 << 20
CHUNK = 1 << 19  # bytes named at a time
# two independent sets of one-byte names
_BYTES, _CHECKS = np.random.default_rng(11).integers(1, 1 << 63, (2, 256), dtype=np.uint64)
PAIR_KINDS = ("<u8", "<u4")  # of the second names in the two sorts
REQUEST = "part int, block int, keys binary, pairs binary"
REPLY = "step int, part int, block int, n long, earlier binary, shared binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>"


def _pair(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    """Names of pairs of names."""
    x = a * np.uint64(0xBF58476D1CE4E5B9) + (b ^ b >> np.uint64(29)) * np.uint64(0x94D049BB133111EB) + np.uint64(salt)
    return x ^ x >> np.uint64(32)


def _double(names: np.ndarray, length: int, to: int) -> np.ndarray:
    """Names of length ``to`` from names of ``length``, doubling."""
    while length < to:
        step = min(length, to - length)  # the last step may overlap
        names = _pair(names[:len(names) - step], names[step:], step)
        length += step
    return names


def _chunks(texts: list[bytes]):
    """``(base, raw, ends)``: pieces of the block's bytes with the ends of their texts.

    A text longer than ``CHUNK`` comes in several pieces that share LENGTH - 1 bytes,
    so each window lies whole in exactly one piece.
    """
    base, part, size = 0, [], 0
    for text in texts:
        if size and size + len(text) > CHUNK:
            yield base, b"".join(part), np.cumsum([len(t) for t in part])
            base, part, size = base + size, [], 0
        if len(text) <= CHUNK:
            part.append(text)
            size += len(text)
            continue
        for at in range(0, len(text) - LENGTH + 1, CHUNK):
            piece = text[at:at + CHUNK + LENGTH - 1]
            yield base + at, piece, np.array([len(piece)])
        base += len(text)
    if part:
        yield base, b"".join(part), np.cumsum([len(t) for t in part])


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(first, last, name, cover)`` per anchor: its first and last window start (in the
    joined bytes of the texts), its 32-byte name and the name of all bytes of its windows."""
    out = [[], [], [], []]
    for base, raw, ends in _chunks(texts):
        if len(raw) < LENGTH:
            continue
        short = _double(_BYTES[np.frombuffer(raw, np.uint8)], 1, SEED_LENGTH)
        long = _pair(short[:-SEED_LENGTH], short[SEED_LENGTH:], SEED_LENGTH)
        # smallest name in each window, leftmost of equals: the position rides in the low bits
        low = np.uint64((2 * CHUNK).bit_length())
        least = (short >> low << low) | np.arange(len(short), dtype=np.uint64)
        count, have = LENGTH - SEED_LENGTH + 1, 1
        while have < count:
            step = min(have, count - have)
            least = np.minimum(least[:len(least) - step], least[step:])
            have += step
        starts = np.arange(len(least))
        sizes = np.diff(ends, prepend=0)
        real = np.flatnonzero(starts + LENGTH <= np.repeat(ends, sizes)[:len(starts)])
        if not len(real):
            continue
        place = (least[real] & np.uint64((1 << int(low)) - 1)).astype(np.int64)
        new = np.flatnonzero((np.diff(place, prepend=-1) != 0) | (np.diff(real, prepend=-2) != 1))
        first, last = real[new], real[np.append(new[1:], len(real)) - 1]
        covered = last - first + LENGTH
        cover = _pair(_pair(long[first], long[first + (covered - 64) // 2], 1), long[last + LENGTH - 64], 2)
        cover = _pair(cover, covered.astype(np.uint64), 3)
        # anchors are the small names: spread them evenly over the name space again
        name = short[place[new]] * np.uint64(0x9E3779B97F4A7C15)
        name ^= name >> np.uint64(32)
        for column, values in zip(out, (first + base, last + base, name, cover)):
            column.append(values)
    kinds = (np.int64, np.int64, np.uint64, np.uint64)
    return tuple(np.concatenate(c) if c else np.zeros(0, k) for c, k in zip(out, kinds))


def window_names(texts: list[bytes], first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(start, name, check)`` of every window of the given anchors, in order."""
    joined = np.frombuffer(b"".join(texts), np.uint8)
    out = [[np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]]
    size = last - first + LENGTH
    groups = np.cumsum(size) // CHUNK
    for g in np.unique(groups):
        a, n = first[groups == g], size[groups == g]
        ends = np.cumsum(n)
        at = np.arange(ends[-1]) - np.repeat(ends - n, n) + np.repeat(a, n)
        raw = joined[at]
        names = _double(_BYTES[raw], 1, LENGTH)
        inside = at[:len(names)] <= np.repeat(a + n - LENGTH, n)[:len(names)]
        out[0].append(at[:len(names)][inside])
        out[1].append(names[inside])
        out[2].append(_double(_CHECKS[raw], 1, LENGTH)[inside] >> np.uint64(32))
    return tuple(np.concatenate(c) for c in out)


def _distinct_pairs(name: np.ndarray, cover: np.ndarray):
    """Distinct (name, cover) in sorted order: ``(order of firsts, place of each, is first)``."""
    order = np.lexsort((np.arange(len(name)), cover, name))
    n, c = name[order], cover[order]
    new = np.ones(len(n), bool)
    new[1:] = (n[1:] != n[:-1]) | (c[1:] != c[:-1])
    place = np.empty(len(n), np.int64)
    place[order] = np.cumsum(new) - 1
    is_first = np.zeros(len(n), bool)
    is_first[order[new]] = True
    return order[new], place, is_first


def _in_order(frame):
    """The block's rows in order, and the texts in UTF-8."""
    frame = frame.sort_values(ORDER, kind="stable").reset_index(drop=True)
    return frame, [t.encode() for t in frame["text"]]


def _bits(replies, step: int, name: str) -> np.ndarray:
    mine = replies[replies["step"] == step].sort_values("part")
    parts = [np.unpackbits(np.frombuffer(b, np.uint8), count=int(n)).astype(bool) for n, b in zip(mine["n"], mine[name])]
    return np.concatenate(parts) if parts else np.zeros(0, bool)


def _ask_anchors(parts: int):
    def run(frame):
        import pandas as pd

        block = int(frame["block"].iloc[0])
        _, texts = _in_order(frame)
        _, _, name, cover = anchors(texts)
        firsts, _, _ = _distinct_pairs(name, cover)
        name, cover = name[firsts], cover[firsts]
        out = [(part, block, pack_keys(name[a:b]), cover[a:b].astype(PAIR_KINDS[0]).tobytes())
               for part, a, b in range_edges(name, parts)] if len(name) else []
        return pd.DataFrame(out, columns=["part", "block", "keys", "pairs"])

    return run


def _answer(step: int):
    """Per entry of each block: does an earlier block have it, and has its name other pairs."""

    def run(frame):
        import pandas as pd

        keys = [unpack_keys(k) for k in frame["keys"]]
        sizes = [len(k) for k in keys]
        block = np.repeat(frame["block"].to_numpy(), sizes)
        name = np.concatenate(keys)
        pair = np.concatenate([np.frombuffer(p, PAIR_KINDS[step]) for p in frame["pairs"]])
        order = np.lexsort((block, pair, name))
        n, p = name[order], pair[order]
        new_name = np.append(True, n[1:] != n[:-1])
        new_pair = new_name | np.append(True, p[1:] != p[:-1])
        earlier, shared = np.empty(len(n), bool), np.empty(len(n), bool)
        earlier[order] = ~new_pair
        group = np.cumsum(new_name) - 1
        shared[order] = (np.bincount(group, new_pair) > 1)[group]
        out, at = [], 0
        for b, size in zip(frame["block"], sizes):
            out.append((step, int(frame["part"].iloc[0]), b, size, np.packbits(earlier[at:at + size]).tobytes(),
                        np.packbits(shared[at:at + size]).tobytes()))
            at += size
        return pd.DataFrame(out, columns=["step", "part", "block", "n", "earlier", "shared"])

    return run


def _open_windows(texts: list[bytes], replies):
    """The anchors with their verdict, and the windows still open after the first sort."""
    first, last, name, cover = anchors(texts)
    _, place, is_first = _distinct_pairs(name, cover)
    earlier, shared = (_bits(replies, 0, x)[place] for x in ("earlier", "shared"))
    whole = earlier | ~is_first
    still = ~whole & shared
    return first[whole], last[whole], *window_names(texts, first[still], last[still])


def _ask_windows(parts: int):
    def run(_, frame, replies):
        import pandas as pd

        columns = ["part", "block", "keys", "pairs"]
        if not len(frame):
            return pd.DataFrame([], columns=columns)
        _, texts = _in_order(frame)
        _, _, _, name, check = _open_windows(texts, replies)
        firsts, _, _ = _distinct_pairs(name, check)
        name, check = name[firsts], check[firsts]
        block = int(frame["block"].iloc[0])
        return pd.DataFrame([(part, block, pack_keys(name[a:b]), check[a:b].astype(PAIR_KINDS[1]).tobytes())
                             for part, a, b in range_edges(name, parts)] if len(name) else [], columns=columns)

    return run


def _cut_out(_, frame, replies):
    import pandas as pd

    columns = [c.split()[0] for c in RESULT.split(", ")]
    if not len(frame):
        return pd.DataFrame([], columns=columns)
    frame, texts = _in_order(frame)
    first, last, start, name, check = _open_windows(texts, replies)
    _, place, is_first = _distinct_pairs(name, check)
    again = ~is_first  # and the first in this block too, if an earlier block has the name
    if len(name):
        again |= _bits(replies, 1, "earlier")[place]
    ends = np.cumsum([len(t) for t in texts])
    steps = np.zeros(int(ends[-1]) + 1, np.int32)
    np.add.at(steps, first, 1)
    np.add.at(steps, last + LENGTH, -1)
    np.add.at(steps, start[again], 1)
    np.add.at(steps, start[again] + LENGTH, -1)
    gone = np.cumsum(steps[:-1]) > 0
    out = []
    for doc, none, text, end in zip(frame["doc_id"], frame["no_id"], texts, ends.tolist()):
        mine = gone[end - len(text):end]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], mine, [False]]).astype(np.int8)))
        kept = np.frombuffer(text, np.uint8)[~mine].tobytes()
        out.append((None if none else int(doc), len(text), int(mine.sum()), len(edges) // 2,
                    hashlib.sha256(kept).hexdigest(), edges.tolist()))
    return pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64"})


def block_starts(rows: DataFrame, blocks: int, size: int) -> list[tuple]:
    """The first document (as ``ORDER``) of each block but the first: blocks of about equal bytes.

    A range sort of narrow rows, running sums of bytes within its partitions, and prefix sums over
    the partitions. One row per block reaches the driver. Rows alike in ``ORDER`` stay together, and a
    text longer than a block is one.
    """
    narrow = rows.select(*ORDER, (F.octet_length("text") + 64).cast("long").alias("bytes"))
    placed = written(narrow.repartitionByRange(*ORDER).withColumn("part", F.spark_partition_id()), "repeats-order")
    parts = placed.groupBy("part").agg(F.sum("bytes").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))  # a row per partition
    inside = Window.partitionBy("part").orderBy(*ORDER).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ends = placed.withColumn("upto", F.sum("bytes").over(inside)).join(parts, "part")
    block = F.floor((F.col("base") + F.col("upto") - 1) * blocks / F.lit(max(size, 1)))
    starts = ends.groupBy(block.alias("block")).agg(F.min(F.struct(*ORDER)).alias("start")).orderBy("block").collect()
    return [tuple(r.start) for r in starts[1:]]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   block_bytes: int | None = None, range_bytes: int | None = None) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans``.

    Removed is every byte covered by a 100-byte string that also starts earlier:
    in a row of smaller id, or earlier in the same row; overlaps count, and
    strings never cross rows. ``spans`` lists start and end of each maximal removed
    run in the UTF-8 bytes. Null text is empty and, like any text under 100 bytes, loses
    nothing. A null id comes after all others; rows of one id come in the order of their
    first ``TIE_CHARS`` characters, then of a hash, so the second of two equal rows is
    removed and many rows without id are many blocks. Extra columns are
    ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("doc_id"), F.col(id_col).isNull().alias("no_id"),
                       text_or_empty(text_col).alias("text"))
    rows = rows.select("*", F.substring("text", 1, TIE_CHARS).alias("head"), F.xxhash64("text").alias("tie"))
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = max(1, -(-size // (block_bytes or exchange_size(size, BLOCK_BYTES, 2048))))
    parts = max(1, -(-size // (range_bytes or exchange_size(size, RANGE_BYTES, 2048))))
    starts = block_starts(rows, blocks, size) if blocks > 1 else []

    @F.pandas_udf("int")
    def block_of(none, ids, head, tie):
        import pandas as pd

        return pd.Series([bisect_right(starts, x) for x in zip(none, ids, head, tie)], dtype="int32")

    rows = rows.withColumn("block", block_of(*ORDER))
    grouped = rows.groupBy("block")
    folders = [scratch_path(spark, f"repeats-{n}") for n in (0, 1)]
    with released_shuffles(spark):
        (grouped.applyInPandas(_ask_anchors(parts), REQUEST).groupBy("part")
         .applyInPandas(_answer(0), REPLY).write.parquet(folders[0]))
    replies = spark.read.schema(REPLY).parquet(folders[0])
    with released_shuffles(spark):
        (grouped.cogroup(replies.groupBy("block")).applyInPandas(_ask_windows(parts), REQUEST).groupBy("part")
         .applyInPandas(_answer(1), REPLY).write.parquet(folders[1]))
    replies = replies.unionByName(spark.read.schema(REPLY).parquet(folders[1]))
    return grouped.cogroup(replies.groupBy("block")).applyInPandas(_cut_out, RESULT)
