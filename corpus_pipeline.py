"""Corpus pipeline: quality, exact copies, near copies, source mix, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and reread as the next stage's
``docs``. All but the last return the columns of ``documents``. Stages accept
null text and source, empty tables and extra columns (which they carry along,
whatever their names, except that a name starting with ``_cp_`` is reserved).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketpulse.llm import exact_dedup, mixing, packing, quality_fm, simhash
from marketpulse.llm.common import cut, load
from marketpulse.llm.queries import vocabulary
from marketpulse.session import scratch_path

ROW = ("_cp_file", "_cp_row")


def with_row_key(docs: DataFrame) -> DataFrame:
    """Adds a key of each row that is the same in every read: its file and place in it."""
    try:
        return docs.select("*", F.col("_metadata.file_path").alias(ROW[0]), F.col("_metadata.row_index").alias(ROW[1]))
    except AnalysisException:  # not read from files: fix the rows first
        return cut(docs.select("*", F.lit("").alias(ROW[0]), F.monotonically_increasing_id().alias(ROW[1])))


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier rejects go (score below one half).

    Every row is scored for itself, by its whole text: a null or empty text, one of any length and repeated
    rows too; a score of exactly one half stays. Rows are otherwise unchanged.
    """
    model = quality_fm.train(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    scored = quality_fm.with_score(docs.withColumn("_cp_text", F.col("text")), model, "_cp_text", "_cp_score")
    return scored.where("_cp_score >= 0.5").select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space the one with the most code points stays.

    Ties go to the smallest id (null last); of rows alike in both, and so of repeated rows, exactly one stays.
    Null and empty texts are equal. Texts of any length are compared by digest and length.
    """
    keyed = with_row_key(docs)
    gone = exact_dedup.exact_dedup(keyed, carry=ROW).where("not kept").select(*ROW)
    return keyed.join(gone, list(ROW), "left_anti").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the row of the smallest id stays (null last), one of them if it is repeated.

    Ties in the id go to the row that comes first in the files. Null, empty and wordless texts share the
    fingerprint zero. Whole texts of any length are fingerprinted.
    """
    keyed = with_row_key(docs)
    rows = simhash.simhash_components(keyed, carry=ROW)
    # the survivor is a combined minimum per fingerprint group, so copies never meet in one task
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *ROW)
    rows = rows.withColumn("place", place)
    stays = rows.groupBy("group_id").agg(F.min("place").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    gone = rows.join(stays, "group_id").where("place != least").select(*ROW)
    return keyed.join(gone, list(ROW), "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, whole: its words taken over its size, rounded.

    A shard's last document, of which the mix takes a part, stays whole or goes;
    a document without words, so one of null text too, takes none of the budget and is not
    part of the mix. Repeated rows are documents of their own; of rows alike in id and size it
    is open which one a last block takes. A long text is taken whole or not, like any other.
    """
    keyed = with_row_key(docs)
    copies = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    taken = (mixing.mix(keyed, carry=ROW).where("taken > 0").select(*ROW, copies.alias("_cp_n")).where("_cp_n > 0"))
    return (keyed.join(taken, list(ROW)).withColumn("_cp_i", F.explode(F.sequence(F.lit(1), F.col("_cp_n"))))
            .select(*docs.columns))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of 2048 tokens, a row each; ids as little-endian unsigned 32-bit.

    A null text is the end id alone. Repeated rows are packed each; a text longer than a window
    is cut over as many as it needs. The order of documents within a window is that of the scan.
    """
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality", reject_low_quality),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("pack", pack_windows),
]

# the classifier, the fingerprints and the token ids cannot be expressed in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's table is written to the shared folder."""
    docs = load(spark, sf_dir, "documents")
    folder = scratch_path(spark, "corpus")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
