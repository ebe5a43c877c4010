"""Exact duplicates by a tree merge of sorted digest runs.

Every row becomes a narrow digest row; the rows a scan task read form one run.
Runs merge in rounds: in each round the runs whose numbers agree after division by
``fan_in`` (a binomial tree of that arity) are sorted on the digest and merged
into one, keeping per digest the number of rows and the best row so far. A
round shuffles on (merged run, digest), so one run's digests are spread over
all tasks, and a group holding a third of all rows is already one row per run
before the first exchange and ``fan_in`` times fewer in each later round. No
round brings a group, or all runs, to one task.

Equality is verified at every level: a digest counts as the same only together
with an independent 64-bit hash and the length of the normalised text, so
texts that differ in any of the three are never merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketpulse.llm.common import SPACE, cut, text_or_empty

RUNS = 64
FAN_IN = 8


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: int = RUNS,
                carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, row, run, sha, check, n_norm, n_points``: one narrow row per document, materialised."""
    normal = F.regexp_replace(text_or_empty(text_col), SPACE, "")
    rows = (docs.select(F.col(id_col).alias("doc_id"), F.length(text_or_empty(text_col)).alias("n_points"),
                        normal.alias("normal"), *carry)
            .select("doc_id", "n_points", *carry, F.monotonically_increasing_id().alias("row"),
                    F.pmod(F.spark_partition_id(), F.lit(runs)).alias("run"),
                    F.unhex(F.sha2("normal", 256)).alias("sha"), F.xxhash64("normal").alias("check"),
                    F.octet_length("normal").alias("n_norm")))
    return cut(rows)


def merge_runs(rows: DataFrame, runs: int = RUNS, fan_in: int = FAN_IN) -> DataFrame:
    """One row per distinct text: ``sha, check, n_norm, n, best`` after the merge rounds."""
    key = ["sha", "check", "n_norm"]
    # the order of survivors: most code points, then smallest id (null ids last)
    best = F.struct((-F.col("n_points")).alias("order"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    merged = rows.groupBy("run", *key).agg(F.count(F.lit(1)).alias("n"), F.min(best).alias("best"))
    while runs > 1:
        runs = -(-runs // fan_in)
        merged = (merged.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
                  .groupBy("run", *key).agg(F.sum("n").alias("n"), F.min("best").alias("best")))
    return merged.drop("run")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                runs: int = RUNS, fan_in: int = FAN_IN, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256`` and the ``carry`` columns.

    Texts are equal when identical after deleting ASCII white space; null text
    counts as empty. The row with the most code points in its original text
    stays, then the smallest id; a null id comes after all others, and of rows
    alike in both exactly one stays. An empty table gives an empty result;
    other columns are ignored.
    """
    rows = digest_rows(docs, id_col, text_col, runs, carry)
    groups = (merge_runs(rows, runs, fan_in).where("n > 1")
              .select("sha", "check", "n_norm", "n", F.col("best.doc_id").alias("best_id"),
                      F.col("best.row").alias("best_row")))
    return (rows.join(groups, ["sha", "check", "n_norm"], "left")
            .select("doc_id",
                    F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("best_id")).alias("keep_id"),
                    F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                    (F.col("n").isNull() | (F.col("row") == F.col("best_row"))).alias("kept"),
                    F.lower(F.hex("sha")).alias("text_sha256"), *carry))


ORACLE = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n_points,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
           FROM documents),
     w AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256
                                               ORDER BY n_points DESC, doc_id NULLS LAST) AS keep_id,
                  count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM w
"""
