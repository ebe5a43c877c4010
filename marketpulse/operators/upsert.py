"""Type-1 upsert (M1, J4, F7) as a DataFrame operator.

Semantics of ``MERGE INTO tgt USING src ON keys``:

* matched and any compared column differs -> overwrite ``update_cols`` from
  the source (other target columns, e.g. the sector, are kept);
* matched, nothing differs -> row unchanged. Comparison is three-valued by
  default: NULL vs value is unknown, so no update (``null_safe=True`` changes
  that);
* source row matching no target row -> insert ``insert_cols``;
* NULL keys never match, so such source rows are inserted;
* a target row matched by two or more source rows is an error, raised when
  the result is computed.

The result carries ``_change`` in {'insert', 'update', 'copy'}. One plan: a
full outer equi-join on the keys. Source rows with a NULL key go around it, so
they do not gather in one task; the count of source rows per key shares the
join's shuffle. Callers keep the join small by passing only the part of the
target that the source can match (see ``plans.tables.merge_into``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketpulse.functions.columns import all_of, any_differs

CHANGE_COL = "_change"


def upsert_type1(target: DataFrame, source: DataFrame, keys, update_cols, insert_cols=None,
                 compare_cols=None, null_safe: bool = False) -> DataFrame:
    """``target`` after the upsert, plus ``_change``; column types are the target's."""
    keys, update_cols = list(keys), list(update_cols)
    compare_cols = list(compare_cols or update_cols)
    tcols = target.columns
    insert_cols = list(insert_cols or tcols)
    needed = list(dict.fromkeys(keys + update_cols + compare_cols + insert_cols))
    s = {c: F.col(f"_src_{c}") for c in needed}
    t = {c: F.col(c) for c in tcols}
    given = source.select(*[F.col(c).alias(f"_src_{c}") for c in needed])
    has_key = all_of([s[k].isNotNull() for k in keys])
    per_key = F.count(F.lit(1)).over(Window.partitionBy(*[s[k] for k in keys]))
    keyed = given.where(has_key).withColumn("_src_n", per_key)
    joined = (target.withColumn("_tgt_hit", F.lit(True))
              .join(keyed, all_of([t[k] == s[k] for k in keys]), "full_outer"))
    has_t, has_s = F.col("_tgt_hit").isNotNull(), F.col("_src_n").isNotNull()
    # a filter, so that no later projection can prune the check away
    clash = F.raise_error(F.concat(F.lit("several source rows match one target row: "),
                                   F.to_json(F.struct(*[t[k] for k in keys]))))
    joined = joined.where(F.when(has_t & (F.col("_src_n") > 1), clash.cast("boolean")).otherwise(True))
    upd = F.coalesce(has_t & has_s & any_differs(t, s, compare_cols, null_safe), F.lit(False))

    def typed(value, c):
        return value.cast(target.schema[c].dataType).alias(c)

    def inserted(c):
        return s[c] if c in insert_cols else F.lit(None)

    def out(c):
        now = F.when(upd, s[c]).otherwise(t[c]) if c in update_cols else t[c]
        return typed(F.when(~has_t, inserted(c)).otherwise(now), c)

    change = F.when(~has_t, F.lit("insert")).when(upd, F.lit("update")).otherwise(F.lit("copy"))
    merged = joined.select(*[out(c) for c in tcols], change.alias(CHANGE_COL))
    keyless = given.where(~has_key).select(*[typed(inserted(c), c) for c in tcols], F.lit("insert").alias(CHANGE_COL))
    return merged.unionByName(keyless)
