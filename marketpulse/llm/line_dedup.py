"""Repeated lines removed through range-partitioned line hashes and per-document keep bitmaps.

Every line whose key (stripped, A-Z lower-cased) is long enough becomes a narrow
row of the key's hash, its document and its position; texts do not move. The
rows are range-partitioned on the hash with document and position as secondary
order and sorted, so a partition streams its occurrences in order and marks
each hash's first one in each document.
Because the range bounds include the document, a line that a third of all
documents share is cut over as many neighbouring partitions as its rows need.
Per hash the marked rows are then counted with the largest document: the partial
aggregate leaves one row per hash and partition before anything moves.

What comes back per document is not text but a compressed bitmap of its lines:
the runs of ones as ``(start, length)``, from which :func:`kept_text` cuts the
text in one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketpulse.llm.common import text_or_empty, written

SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS = 40
MIN_DOCS = 5


def lines_of(text: Column) -> Column:
    """The lines of a text; an empty one has one empty line."""
    return F.split(text, "\n")


def folded(line: Column) -> Column:
    """A-Z lower-cased; an ASCII line takes the faster of two ways."""
    return F.when(F.octet_length(line) == F.char_length(line), F.lower(line)).otherwise(F.translate(line, UPPER, LOWER))


def _once(value: Column, use) -> Column:
    """``use(value)``, with ``value`` computed once however often ``use`` names it in its own lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def kept_text(text: Column, keep_runs: Column) -> Column:
    """The lines whose bit is set, joined by line ends."""
    kept = _once(lines_of(text), lambda lines: F.flatten(
        F.transform(keep_runs, lambda r: F.slice(lines, r["start"] + 1, r["length"]))))
    return F.array_join(kept, "\n")


def _between(gone: Column, n_lines: Column) -> Column:
    """The runs of ones of a bitmap of ``n_lines`` bits with zeros at the sorted places ``gone``."""
    spans = _once(F.concat(F.array(F.lit(-1)), gone, F.array(n_lines)), lambda ends: F.transform(
        F.sequence(F.lit(0), F.size(gone)), lambda i: F.struct(
            (F.get(ends, i) + 1).alias("start"), (F.get(ends, i + 1) - F.get(ends, i) - 1).alias("length"))))
    return F.filter(spans, lambda s: s["length"] > 0)


def _rows(docs: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, digest, text`` of each row; id and digest identify it (rows alike in both fare alike)."""
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("digest"), text.alias("text"),
                       *[F.col(c).alias(f"carry_{c}") for c in carry])


def line_runs(rows: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``hash, doc_id, digest, pos, own, first, part``: the long lines, range-partitioned and sorted, as a table.

    ``first`` marks the first occurrence of a hash in a document, ``part`` is the range
    partition. Rows without id are a document per text (``own``).
    """
    lines = (rows.select("doc_id", "digest", F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
             .select("doc_id", "digest", "pos", F.btrim("line", F.lit(SPACES)).alias("line"))
             .where(F.char_length("line") >= min_chars)
             .select(F.unhex(F.md5(folded(F.col("line")))).alias("hash"), "doc_id", "digest", "pos",
                     F.when(F.col("doc_id").isNull(), F.col("digest")).alias("own")))
    # a table first: finding the range bounds reads its input once more
    runs = written(lines, "lines").repartitionByRange("hash", "doc_id", "own")
    occurrences = Window.partitionBy("hash", "doc_id", "own").orderBy("digest", "pos")
    return written(runs.withColumn("first", F.row_number().over(occurrences) == 1)
                   .withColumn("part", F.spark_partition_id()), "line-runs")


def dropped_lines(runs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id, digest, pos`` of the lines that go: keys of ``min_docs`` documents, except in the last one.

    The verdict on a key goes to each partition that holds some of its rows, so a hot key's rows
    meet it in as many places as they were cut into.
    """
    keys = (runs.where("first").groupBy("hash")
            .agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last"), F.max("own").alias("last_own"),
                 F.min("part").alias("a"), F.max("part").alias("b"))
            .where(F.col("n") >= min_docs)
            .select("hash", "last", "last_own", F.explode(F.sequence("a", "b")).alias("part")))
    last = F.when(F.col("last").isNull(), F.col("own") == F.col("last_own")).otherwise(
        F.col("doc_id").eqNullSafe(F.col("last")))
    return runs.join(keys, ["hash", "part"]).where(~last).select("doc_id", "digest", "pos")


def line_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                 min_docs: int = MIN_DOCS, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``doc_id, n_lines, n_dropped, keep_runs`` and the ``carry`` columns.

    ``keep_runs`` is the compressed keep bitmap, ``array<struct<start, length>>``.
    A key of at least ``min_chars`` code points found in at least ``min_docs``
    documents loses all its lines except in the document of the largest id
    holding it, which keeps all of its own. Rows of one id are one document;
    rows without id are a document per text (by a 64-bit hash, the largest is last) and
    come before all ids. Repeated rows get the same bitmap. A null or empty text is one
    empty line. A text of any length is one row. Other columns are ignored;
    an empty table gives no rows. Keys are compared by their 128-bit MD5.
    """
    rows = _rows(docs, id_col, text_col, carry)
    gone = dropped_lines(line_runs(rows, min_chars), min_docs)
    # repeated rows name a position several times: a set, combined before it moves
    gone = gone.groupBy("doc_id", "digest").agg(F.sort_array(F.collect_set("pos")).alias("gone")).alias("g")
    ends = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    r = rows.select("*", (ends + 1).alias("n_lines")).alias("r")
    same = F.col("r.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("r.digest") == F.col("g.digest"))
    joined = r.join(gone, same, "left").select("r.*", F.coalesce("g.gone", F.array().cast("array<int>")).alias("gone"))
    return joined.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_dropped"),
                         _between(F.col("gone"), F.col("n_lines")).alias("keep_runs"),
                         *[F.col(f"carry_{c}").alias(c) for c in carry])


ORACLE = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
     l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
     k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
     f AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40
           GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
     j AS (SELECT k.*, f.key IS NOT NULL AND doc_id <> last AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
