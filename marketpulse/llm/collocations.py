"""Phrase collocations by direct-address pair tiles over frequency-ranked ids.

Words are numbered per language by falling frequency, so the pairs of frequent
words crowd into the corner of the (first id, second id) plane. The plane is cut
into square tiles. A tile of the corner that a unit of text hits often is
counted densely (``np.bincount`` over its cells); the rest is counted by sorting
(coordinates with counts). Recursively, the frequent pairs are ranked by
frequency again and become the ids of the next level, on which a pair of
overlapping pairs is a phrase of three words, and a pair of those one of four.

The corpus is read once. Scan tasks cut it into units of a bounded number of
tokens and write each as local word numbers with its own word list; words and later
pairs are counted by request: a unit sends its distinct pairs, sorted and packed,
to the tile groups, whose tasks add up all units' counts. Ranks come from a range
sort with prefix sums. Each unit then gets back the ids of those of its pairs
that are frequent, and is rewritten on the next level; places that start no
frequent phrase drop out. Every table is written to the shared folder; no
vocabulary or phrase list is broadcast or collected. A word or pair however
frequent is one entry per unit.

Only words of at least ``min_count`` occurrences can be part of a candidate, as a
phrase never occurs more often than its parts. Counts are exact integers, and
scores are decimal arithmetic of 38 digits.
"""

from __future__ import annotations

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketpulse.llm.common import arrow_batches, exchange_size, released_shuffles, text_or_empty, write_wide, written
from marketpulse.llm.packed import pack_counts, pack_keys, unpack_counts, unpack_keys
from marketpulse.session import scratch_path

MIN_COUNT = 30
TOP = 2000
TILE_BITS = 11
CORNER_TILES = 4
DENSE = 1 << 17
SLICE = 1 << 19  # places of a unit looked at together, which bounds a task's memory
UNIT_BYTES = 12 << 20
BATCH_BYTES = 8 << 20  # of rows given to Python at once
GROUP_BYTES = 8 << 20
SCALE = 2_000_000
GONE = np.uint32(0xFFFFFFFF)  # a place that is no frequent word or phrase, or lies between two pieces
_END = b"\xff"  # no UTF-8 text has this byte
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + _END * 10)
UNIT = "unit long, lang string, ids binary, words array<string>, counts array<long>"
LEVEL = "unit long, lang string, ids binary"
REQUEST = "part int, lang string, unit long, codes binary, counts binary"
FREQUENT = "part int, lang string, code long, f long"
REPLY = "unit long, lang string, codes binary, ids binary"


class _Words(dict):
    """Word -> its number in order of appearance; 0 is the end of a piece."""

    def __missing__(self, word):
        self[word] = i = len(self)
        return i


def _units(unit_tokens: int):
    """Texts -> units: per language the word numbers, the words and their counts."""

    def run(frames):
        import pandas as pd

        task, serial, words, parts, n = TaskContext.get().partitionId(), 0, {}, {}, 0

        def flush():
            nonlocal serial, n
            out = []
            for lang, chunks in parts.items():
                ids = np.concatenate(chunks)
                out.append((task << 24 | serial, lang, ids.tobytes(), [w.decode() for w in list(words[lang])[1:]],
                            np.bincount(ids, minlength=len(words[lang]))[1:].tolist()))
                serial += 1
            words.clear()
            parts.clear()
            n = 0
            return pd.DataFrame(out, columns=["unit", "lang", "ids", "words", "counts"])

        for frame in frames:
            for lang, text in zip(frame["lang"], frame["text"]):
                found = text.encode().translate(_FOLD).replace(_END, b" \xff ").split()
                if lang not in words:
                    words[lang] = _Words({_END: 0})
                    parts[lang] = []
                parts[lang].append(np.fromiter(map(words[lang].__getitem__, found), np.uint32, len(found)))
                parts[lang].append(np.zeros(1, np.uint32))
                n += len(found) + 1
                if n >= unit_tokens:
                    yield flush()
        if n:
            yield flush()

    return run


def _stretches(ids: np.ndarray) -> np.ndarray:
    """``ids`` without places that have no valid neighbour, one gap between the stretches that stay."""
    ok = np.concatenate([[False], ids != GONE, [False]])
    near = ok[1:-1] & (ok[:-2] | ok[2:])
    stay = near | np.concatenate([[False], near[:-1]])  # and one gap after each stretch
    return np.where(near, ids, GONE)[stay]


def _number(frames):
    """Units and the ranked ids of their frequent words -> level one."""
    import pandas as pd

    for frame in frames:
        for unit, lang, ids, places, known in zip(frame["unit"], frame["lang"], frame["ids"], frame["places"], frame["known"]):
            ids = np.frombuffer(ids, np.uint32)
            table = np.full(int(ids.max()) + 1, GONE, np.uint32)
            table[places] = known
            yield pd.DataFrame([(unit, lang, _stretches(table[ids]).tobytes())], columns=["unit", "lang", "ids"])


def pair_codes(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code (first id, second id) of each place with the next one, and which places have one."""
    first, second = ids[:-1], ids[1:]
    return first.astype(np.uint64) << np.uint64(32) | second, (first != GONE) & (second != GONE)


def count_tiles(codes: np.ndarray, weights: np.ndarray | None = None, dense: int = DENSE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order and their counts (sums of ``weights``)."""
    bits, side = TILE_BITS, 1 << TILE_BITS
    tile = _tiles(codes)
    hits = np.bincount(tile, minlength=CORNER_TILES ** 2 + 1)
    found, counted, rest = [], [], None
    for t in np.flatnonzero(hits[:-1] >= dense).tolist():
        mine = tile == t
        rest = ~mine if rest is None else rest & ~mine
        a, b = codes[mine] >> np.uint64(32), codes[mine] & np.uint64(0xFFFFFFFF)
        cell = ((a & np.uint64(side - 1)) << np.uint64(bits) | b & np.uint64(side - 1)).astype(np.int64)
        cells = np.bincount(cell, None if weights is None else weights[mine], side * side).astype(np.int64)
        hit = np.flatnonzero(cells)
        x, y = hit // side + t // CORNER_TILES * side, hit % side + t % CORNER_TILES * side
        found.append(x.astype(np.uint64) << np.uint64(32) | y.astype(np.uint64))
        counted.append(cells[hit])
    del tile
    if rest is None:
        return sum_codes(codes, weights)
    if rest.any():
        sparse = sum_codes(codes[rest], None if weights is None else weights[rest])
        found.append(sparse[0])
        counted.append(sparse[1])
    if len(found) < 2:
        return found[0], counted[0].astype(np.int64)
    found, counted = np.concatenate(found), np.concatenate(counted)
    order = np.argsort(found)
    return found[order], counted[order].astype(np.int64)


def _tiles(codes: np.ndarray) -> np.ndarray:
    """The corner tile of each code, or the number after the last one; slice by slice."""
    out = np.empty(len(codes), np.uint8)
    bits, corner = np.uint64(TILE_BITS), np.uint64(CORNER_TILES << TILE_BITS)
    for i in range(0, len(codes), SLICE):
        a, b = codes[i:i + SLICE] >> np.uint64(32), codes[i:i + SLICE] & np.uint64(0xFFFFFFFF)
        inside = (a < corner) & (b < corner)
        out[i:i + SLICE] = np.where(inside, (a >> bits) * np.uint64(CORNER_TILES) + (b >> bits), CORNER_TILES ** 2)
    return out


def sum_codes(codes: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order and their counts (sums of ``weights``), by sorting."""
    if not len(codes):
        return codes, np.empty(0, np.int64)
    if weights is None:
        codes = np.sort(codes)
        first = np.flatnonzero(np.diff(codes, prepend=~codes[:1]))
        return codes[first], np.diff(first, append=len(codes))
    order = np.argsort(codes)
    codes, weights = codes[order], weights[order]
    del order
    first = np.flatnonzero(np.diff(codes, prepend=~codes[:1]))
    return codes[first], np.add.reduceat(weights, first, dtype=np.int64)


def count_pairs(ids: np.ndarray, dense: int = DENSE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of neighbouring places and their counts, slice by slice."""
    found = []
    for i in range(0, max(1, len(ids)), SLICE):
        codes, ok = pair_codes(ids[i:i + SLICE + 1])
        found.append(count_tiles(codes[ok], dense=dense))
    if len(found) == 1:
        return found[0]
    codes, counts = np.concatenate([c for c, _ in found]), np.concatenate([n for _, n in found])
    found.clear()
    return sum_codes(codes, counts)


def group_of(codes: np.ndarray, lang: str, groups: int, stripes: int) -> np.ndarray:
    """The tile group of each code: a hash of the language and a stripe of rows of its tile."""
    import zlib

    row = codes >> np.uint64(32 + TILE_BITS) << np.uint64(16) | codes >> np.uint64(32) & np.uint64(stripes - 1)
    mixed = (row << np.uint64(24) ^ codes << np.uint64(32) >> np.uint64(32 + TILE_BITS)) + np.uint64(zlib.crc32(lang.encode()))
    mixed = (mixed ^ mixed >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)


def _request(groups: int, stripes: int, dense: int):
    """A level's units -> their distinct pairs with counts, a row per tile group."""

    def run(frames):
        import pandas as pd

        for frame in frames:
            for unit, lang, ids in zip(frame["unit"], frame["lang"], frame["ids"]):
                codes, n = count_pairs(np.frombuffer(ids, np.uint32), dense)
                part = np.empty(len(codes), np.int32)
                for i in range(0, len(codes), SLICE):
                    part[i:i + SLICE] = group_of(codes[i:i + SLICE], lang, groups, stripes)
                order = np.argsort(part, kind="stable")
                part, codes, n = part[order], codes[order], n[order]
                edges = np.flatnonzero(np.diff(part, prepend=np.int32(-1))).tolist()
                # a frame per unit: what a task holds does not follow the units in its batch
                yield pd.DataFrame([(int(part[i]), lang, unit, pack_keys(codes[i:j]), pack_counts(n[i:j]))
                                    for i, j in zip(edges, [*edges[1:], len(codes)])],
                                   columns=["part", "lang", "unit", "codes", "counts"])

    return run


def _merge(min_count: int, dense: int, held: int = 1 << 20):
    """Request rows sorted by group -> the pairs that are frequent; holds one group's distinct pairs."""

    def run(frames):
        import pandas as pd

        now, codes, counts, n = None, [], [], 0

        def compact():
            nonlocal codes, counts, n
            codes, counts = [np.concatenate(codes)], [np.concatenate(counts)]
            merged = count_tiles(codes.pop(), counts.pop(), dense)
            codes, counts, n = [merged[0]], [merged[1]], 0

        def frequent():
            compact()
            hit = counts[0] >= min_count
            return pd.DataFrame({"part": now[0], "lang": now[1], "code": codes[0][hit].view(np.int64), "f": counts[0][hit]})

        for frame in frames:
            for part, lang, c, k in zip(frame["part"], frame["lang"], frame["codes"], frame["counts"]):
                if (part, lang) != now:
                    if now is not None:
                        yield frequent()
                    now, codes, counts, n = (part, lang), [], [], 0
                codes.append(unpack_keys(c))
                counts.append(unpack_counts(k))
                n += len(codes[-1])
                if n >= max(held, len(codes[0])):
                    compact()
        if now is not None:
            yield frequent()

    return run


def _reply(frames):
    """Per group the ranked pairs first, then the requests -> each unit's frequent pairs with their ids."""
    import pandas as pd

    now, known, ids, ready = None, [], [], False
    for frame in frames:
        out = []
        # stretches of rows of one group and kind
        same = (frame["part"].ne(frame["part"].shift()) | frame["lang"].ne(frame["lang"].shift())
                | frame["asks"].ne(frame["asks"].shift())).to_numpy()
        edges = np.flatnonzero(same).tolist()
        for i, j in zip(edges, [*edges[1:], len(frame)]):
            rows = frame.iloc[i:j]
            key = (int(rows["part"].iloc[0]), rows["lang"].iloc[0])
            if key != now:
                now, known, ids, ready = key, [], [], False
            if not rows["asks"].iloc[0]:
                known.append(rows["code"].to_numpy(np.int64).view(np.uint64))
                ids.append(rows["id"].to_numpy(np.int64))
                continue
            if not known:
                continue
            if not ready:
                known, ids, ready = [np.concatenate(known)], [np.concatenate(ids)], True
                order = np.argsort(known[0])
                known, ids = [known[0][order]], [ids[0][order].astype(np.uint32)]
            for unit, codes in zip(rows["unit"], rows["codes"]):
                codes = unpack_keys(codes)
                place = np.minimum(np.searchsorted(known[0], codes), len(known[0]) - 1)
                hit = known[0][place] == codes
                if hit.any():
                    out.append((int(unit), now[1], pack_keys(codes[hit]), ids[0][place[hit]].tobytes()))
        yield pd.DataFrame(out, columns=["unit", "lang", "codes", "ids"])


def _raise_level(frames):
    """A level's units and their replies -> the next level."""
    import pandas as pd

    for frame in frames:
        for unit, lang, ids, keys, numbers in zip(frame["unit"], frame["lang"], frame["ids"], frame["keys"], frame["numbers"]):
            known = np.concatenate([unpack_keys(k) for k in keys])
            number = np.concatenate([np.frombuffer(x, np.uint32) for x in numbers])
            order = np.argsort(known)
            known, number = known[order], number[order]
            ids, raised = np.frombuffer(ids, np.uint32), []
            for i in range(0, len(ids), SLICE):
                codes, ok = pair_codes(ids[i:i + SLICE + 1])
                place = np.minimum(np.searchsorted(known, codes), len(known) - 1)
                raised.append(np.where(ok & (known[place] == codes), number[place], GONE))
            ids = _stretches(np.concatenate(raised))
            if len(ids):
                yield pd.DataFrame([(unit, lang, ids.tobytes())], columns=["unit", "lang", "ids"])


def ranked(rows: DataFrame, tie: str) -> DataFrame:
    """``rows`` with ``id``: their place from 0 within ``lang`` by falling ``f``, then ``tie``; materialised.

    A range sort, then prefix sums over the counts of the sorted partitions.
    """
    order = ["lang", F.desc("f"), tie]
    placed = written(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                     .select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row")), "ranks")
    parts = placed.groupBy("lang", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy("lang").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    number = F.col("_base") + F.col("_row") - F.col("_first")
    limit = F.lit(int(GONE))
    return written(placed.join(parts, ["lang", "_part"]).select(*rows.columns, F.when(number < limit, number).otherwise(
        F.raise_error(F.lit("more phrases of a language than 32-bit ids"))).cast("long").alias("id")), "ranked")


def _score(a: Column, left: Column, right: Column) -> Column:
    wide = "decimal(20,0)"
    return F.call_function("div", a.cast(wide) * F.lit(SCALE).cast("decimal(7,0)"), left.cast(wide) + right.cast(wide))


def _level(folder: str, level: int, units: DataFrame, groups: int, stripes: int, min_count: int,
           dense: int, last: bool) -> tuple[DataFrame, DataFrame | None]:
    """The frequent pairs of a level, ranked, and the units on the next level."""
    spark = units.sparkSession
    with released_shuffles(spark), arrow_batches(spark, BATCH_BYTES):
        write_wide(units.mapInPandas(_request(groups, stripes, dense), REQUEST), f"{folder}/requests{level}")
        requests = spark.read.schema(REQUEST).parquet(f"{folder}/requests{level}")
        frequent = (requests.repartition("part").sortWithinPartitions("part", "lang")
                    .mapInPandas(_merge(min_count, dense), FREQUENT))
        frequent = ranked(frequent, "code")
        if last:
            return frequent, None
        asks = requests.select("part", "lang", F.lit(True).alias("asks"), "unit", "codes",
                               F.lit(0).cast("long").alias("code"), F.lit(0).cast("long").alias("id"))
        known = frequent.select("part", "lang", F.lit(False).alias("asks"), F.lit(0).cast("long").alias("unit"),
                                F.lit(b"").alias("codes"), "code", "id")
        replies = (known.unionByName(asks).repartition("part").sortWithinPartitions("part", "lang", "asks")
                   .mapInPandas(_reply, REPLY))
        replies = (replies.groupBy("unit", "lang").agg(F.collect_list(F.struct("codes", "ids")).alias("r"))
                   .select("unit", "lang", F.col("r.codes").alias("keys"), F.col("r.ids").alias("numbers")))
        write_wide(units.join(replies, ["unit", "lang"]).mapInPandas(_raise_level, LEVEL), f"{folder}/level{level}")
    return frequent, spark.read.schema(LEVEL).parquet(f"{folder}/level{level}")


def phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT, top: int = TOP,
            unit_bytes: int | None = None, group_bytes: int | None = None, dense: int = DENSE) -> DataFrame:
    """The best phrases of 2 to 4 words per language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are folded (A-Z), cut into pieces at ``[.,;:!?]`` and line ends and into
    words at blanks and tabs; null texts are empty, a null language is ``und``.
    A phrase with ``a >= min_count`` occurrences within pieces scores
    ``floor(2000000 a / (l + r))`` at its lowest cut into parts of ``l`` and ``r`` occurrences (ties: the
    first cut), and goes if a longer candidate around it has at least 80 % of its
    occurrences. ``top`` phrases per language by score, occurrences and text.
    Repeated rows count every time; ids and extra columns are not read; an empty
    table gives no rows. Long texts are one row each.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(lang_col, F.lit("und")).alias("lang"), text_or_empty(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    unit_tokens = max(1, (unit_bytes or exchange_size(size, UNIT_BYTES, 640)) // 6)
    groups = max(1, -(-size // (group_bytes or exchange_size(size, GROUP_BYTES, 640))))
    stripes = 1 << min(TILE_BITS, max(0, groups.bit_length() - 3))
    folder = scratch_path(spark, "phrases")
    with released_shuffles(spark), arrow_batches(spark, BATCH_BYTES):
        write_wide(rows.mapInPandas(_units(unit_tokens), UNIT), f"{folder}/units")
    units = spark.read.schema(UNIT).parquet(f"{folder}/units")
    words = (units.select("unit", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "w"))
             .select("unit", "lang", (F.col("place") + 1).alias("place"), F.col("w.words").alias("word"),
                     F.col("w.counts").alias("n")))
    with released_shuffles(spark), arrow_batches(spark, BATCH_BYTES):
        vocabulary = ranked(words.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= min_count), "word")
        totals = written(words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
        known = (words.join(vocabulary, ["lang", "word"]).groupBy("unit", "lang")
                 .agg(F.collect_list(F.struct("place", "id")).alias("k"))
                 .select("unit", "lang", F.col("k.place").alias("places"), F.col("k.id").alias("known")))
        write_wide(units.select("unit", "lang", "ids").join(known, ["unit", "lang"]).mapInPandas(_number, LEVEL),
                   f"{folder}/level1")
    level = spark.read.schema(LEVEL).parquet(f"{folder}/level1")
    two, level = _level(folder, 2, level, groups, stripes, min_count, dense, False)
    three, level = _level(folder, 3, level, groups, stripes, min_count, dense, False)
    four, _ = _level(folder, 4, level, groups, stripes, min_count, dense, True)
    return best_phrases(vocabulary, two, three, four, totals, top)


def _parts(pairs: DataFrame, below: DataFrame) -> DataFrame:
    """``pairs`` with the two overlapping phrases of the level below as structs ``x`` and ``y``."""
    split = pairs.select("lang", "id", "f", F.shiftrightunsigned("code", 32).alias("i"),
                         F.col("code").bitwiseAND(0xFFFFFFFF).alias("j"))
    side = F.struct(*[c for c in below.columns if c != "lang"])
    first = below.select("lang", F.col("id").alias("i"), side.alias("x"))
    second = below.select("lang", F.col("id").alias("j"), side.alias("y"))
    return split.join(first, ["lang", "i"]).join(second, ["lang", "j"])


def _candidates(level: DataFrame, cuts: list[tuple[Column, Column]], longer: DataFrame | None) -> DataFrame:
    """Candidates of one length with their lowest cut, without those inside a longer candidate."""
    scored = [F.struct(_score(F.col("f"), left, right).alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))
              for k, (left, right) in enumerate(cuts, 1)]
    out = level.select("lang", "id", "phrase", F.col("f").alias("a"),
                       (F.least(*scored) if len(scored) > 1 else scored[0]).alias("cut"))
    if longer is not None:
        inside = (longer.select("lang", F.explode(F.array(F.col("x.id"), F.col("y.id"))).alias("id"), "f")
                  .groupBy("lang", "id").agg(F.max("f").alias("around")))
        wide = "decimal(20,0)"
        # 100 longer >= 80 a, in lowest terms
        gone = F.col("around").cast(wide) * 5 >= F.col("a").cast(wide) * 4
        out = out.join(inside, ["lang", "id"], "left").where(F.col("around").isNull() | ~gone)
    return out.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def best_phrases(vocabulary: DataFrame, two: DataFrame, three: DataFrame, four: DataFrame, totals: DataFrame,
                 top: int = TOP) -> DataFrame:
    """Scores all candidates from the ranked tables and keeps the best per language."""
    blank = F.lit(" ")
    two = written(_parts(two, vocabulary).select("*", F.concat("x.word", blank, "y.word").alias("phrase")), "phrases")
    flat = two.select("lang", "id", "f", "phrase", F.col("x.f").alias("first"), F.col("y.f").alias("last"),
                      F.col("y.word").alias("word"))
    three = written(_parts(three, flat).select("*", F.concat("x.phrase", blank, "y.word").alias("phrase")), "phrases")
    flat = three.select("lang", "id", "f", "phrase", F.col("x.first").alias("first"), F.col("y.last").alias("last"),
                        F.col("y.word").alias("word"), F.col("x.f").alias("head"), F.col("y.f").alias("tail"))
    four = written(_parts(four, flat).select("*", F.concat("x.phrase", blank, "y.word").alias("phrase")), "phrases")

    def c(name):
        return F.col(name)

    found = (_candidates(two, [(c("x.f"), c("y.f"))], three)
             .unionByName(_candidates(three, [(c("x.first"), c("y.f")), (c("x.f"), c("y.last"))], four))
             .unionByName(_candidates(four, [(c("x.first"), c("y.f")), (c("x.head"), c("y.tail")), (c("x.f"), c("y.last"))], None)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
     p AS (SELECT lang, row_number() OVER () AS piece, piece AS t
           FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
     w AS (SELECT lang, piece, unnest(w) AS w1, generate_subscripts(w, 1) AS i
           FROM (SELECT lang, piece, regexp_extract_all(t, '[^\x20\x09]+') AS w FROM p)),
     g AS (SELECT lang, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4
           FROM w WINDOW o AS (PARTITION BY piece ORDER BY i)),
     c AS (SELECT lang, k, CASE k WHEN 1 THEN w1 WHEN 2 THEN w1 || ' ' || w2 WHEN 3 THEN w1 || ' ' || w2 || ' ' || w3
                  ELSE w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 END AS phrase, count(*) AS f
           FROM g, (SELECT unnest(range(1, 5)) AS k)
           WHERE CASE k WHEN 1 THEN w1 WHEN 2 THEN w2 WHEN 3 THEN w3 ELSE w4 END IS NOT NULL GROUP BY ALL),
     k AS (SELECT unnest(range(1, 5)) AS k),
     n AS (SELECT lang, sum(f) AS n FROM c WHERE k = 1 GROUP BY lang),
     q AS (SELECT *, string_split(phrase, ' ') AS w FROM c WHERE k > 1 AND f >= 30),
     cuts AS MATERIALIZED (SELECT q.lang, q.phrase, q.f, k.k AS cut_at, array_to_string(q.w[:k.k], ' ') AS head,
                                  array_to_string(q.w[k.k + 1:], ' ') AS tail FROM q JOIN k ON k.k < q.k),
     s AS (SELECT cuts.*, x.f AS l, y.f AS r, (2000000 * cuts.f::HUGEINT) // (x.f + y.f) AS score
           FROM cuts JOIN c x ON x.lang = cuts.lang AND x.phrase = cuts.head
           JOIN c y ON y.lang = cuts.lang AND y.phrase = cuts.tail),
     low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut_at) = 1),
     sub AS (SELECT q.lang, array_to_string(q.w[i:i + k.k - 1], ' ') AS phrase, max(q.f) AS around
             FROM q JOIN k ON k.k > 1 AND k.k < q.k, unnest(range(1, 4)) AS t(i)
             WHERE i + k.k - 1 <= q.k GROUP BY ALL),
     best AS (SELECT low.lang, row_number() OVER (PARTITION BY low.lang ORDER BY score DESC, f DESC, low.phrase) AS rank,
                     low.phrase, f AS a, l, r, score
              FROM low LEFT JOIN sub ON sub.lang = low.lang AND sub.phrase = low.phrase
              WHERE around IS NULL OR 100 * around::HUGEINT < 80 * f::HUGEINT)
SELECT best.lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM best JOIN n ON n.lang = best.lang WHERE rank <= 2000
"""
