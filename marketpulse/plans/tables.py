"""Table sinks on plain Parquet folders (SK1-SK3).

A table that grows by loads is a folder per load::

    <root>/load=<id>/<partition>=<value>/part-*.parquet

A load is one Spark write into its own folder, in overwrite mode: it becomes
visible when the write job commits (readers skip Spark's ``_temporary``
files until then), and a repeated attempt under the same id replaces what an
earlier one left, so a retry neither duplicates nor mixes rows. Reading the
table is one scan of all loads with a declared schema. One writer per load id
is assumed.

What replaces rows is written beside the table first, into a hidden folder of the
same parent, and moved in its place when the write job has committed, so a write that fails
leaves the old rows, and a table may be read for its own replacement. A process
lost between the moves leaves the complete new folder there, and ``finish_moves`` (which
every later write of the table calls first) does the rest of them.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from marketpulse.operators.upsert import CHANGE_COL, upsert_type1

LOAD = "load"


def _store(spark: SparkSession, path: str):
    """The file system of a path, and the path as it names it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in whatever store it names."""
    fs, target = _store(spark, path)
    return fs.exists(target)


def write_partitioned(df: DataFrame, path: str, *partition_cols: str) -> None:
    """Parquet write into a folder of its own, partitioned by columns, the last one a date.

    ``REBALANCE`` on the last column lets AQE split a date holding a large
    share of the rows over several writers and merge small ones, so the file
    count per date stays bounded without funnelling a hot date through one
    task.
    """
    (df.hint("rebalance", partition_cols[-1]).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(*partition_cols).parquet(path))


def _beside(path: str, what: str) -> str:
    parent, name = path.rstrip("/").rsplit("/", 1)
    return f"{parent}/_{name}.{what}"


def _move(spark: SparkSession, source: str, target: str) -> None:
    fs, a = _store(spark, source)
    b = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"cannot move {source} to {target}")


def _delete(spark: SparkSession, path: str) -> None:
    fs, target = _store(spark, path)
    fs.delete(target, True)


def _folders(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names of the folders in a folder, none if it does not exist."""
    fs, target = _store(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target)
                  if s.isDirectory() and s.getPath().getName().startswith(prefix))


def finish_moves(spark: SparkSession, path: str) -> None:
    """Complete what a lost process has written for ``path`` but not moved; drop what it has not finished writing."""
    parent, name = path.rstrip("/").rsplit("/", 1)
    for kind in ("whole", "part"):
        for folder in _folders(spark, parent, f"_{name}.{kind}-"):
            if path_exists(spark, f"{parent}/{folder}/_SUCCESS"):
                (_replace if kind == "whole" else _replace_parts)(spark, f"{parent}/{folder}", path)
            else:
                _delete(spark, f"{parent}/{folder}")
    for folder in _folders(spark, parent, f"_{name}.gone-"):
        _delete(spark, f"{parent}/{folder}")
    for folder in _folders(spark, parent, f"_{name}.old-"):
        if path_exists(spark, path):
            _delete(spark, f"{parent}/{folder}")
        else:
            _move(spark, f"{parent}/{folder}", path)


def _replace(spark: SparkSession, staged: str, path: str) -> None:
    old = _beside(path, f"old-{uuid.uuid4().hex}")
    if path_exists(spark, path):
        _move(spark, path, old)
    _move(spark, staged, path)
    _delete(spark, old)


def _replace_parts(spark: SparkSession, staged: str, path: str) -> None:
    old = _beside(path, f"gone-{uuid.uuid4().hex}")
    for part in _folders(spark, staged):
        if "=" in part:
            if path_exists(spark, f"{path}/{part}"):
                _move(spark, f"{path}/{part}", f"{old}/{part}")
            _move(spark, f"{staged}/{part}", f"{path}/{part}")
    _delete(spark, staged)
    _delete(spark, old)


def replace_table(df: DataFrame, path: str, *partition_cols: str) -> None:
    """Replace a table: written beside it, then moved in its place."""
    spark = df.sparkSession
    finish_moves(spark, path)
    staged = _beside(path, f"whole-{uuid.uuid4().hex}")
    write_partitioned(df, staged, *partition_cols)
    _replace(spark, staged, path)


def replace_partitions(df: DataFrame, path: str, partition_col: str) -> None:
    """Replace the partitions that ``df`` has rows of: written beside the table, then moved one by one.

    All other partitions keep their files.
    """
    spark = df.sparkSession
    finish_moves(spark, path)
    staged = _beside(path, f"part-{uuid.uuid4().hex}")
    write_partitioned(df, staged, partition_col)
    _replace_parts(spark, staged, path)


def write_load(df: DataFrame, root: str, load_id: str, partition_col: str) -> None:
    """Add one load, or replace the load of that id (SK2)."""
    folder = f"{root}/{LOAD}={load_id}"
    finish_moves(df.sparkSession, folder)
    if path_exists(df.sparkSession, f"{folder}/_SUCCESS"):
        replace_table(df, folder, partition_col)
    else:
        write_partitioned(df, folder, partition_col)


def replace_loads(df: DataFrame, root: str, load_id: str, partition_col: str) -> None:
    """Replace the table by one load (SK1)."""
    replace_table(df.withColumn(LOAD, F.lit(load_id)), root, LOAD, partition_col)


def _loads(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    return spark.read.schema(StructType([*schema.fields, StructField(LOAD, StringType())])).parquet(root)


def read_loads(spark: SparkSession, root: str, schema: StructType, without: str | None = None) -> DataFrame:
    """All loads of a table, or all but one, whose files are then not read."""
    loads = _loads(spark, root, schema)
    return (loads if without is None else loads.where(F.col(LOAD) != without)).drop(LOAD)


def free_load_id(spark: SparkSession, root: str, schema: StructType, load_id: str) -> str:
    """``load_id``, or with the first number that makes it differ from every load with rows."""
    # a filter on folder names: only loads of this name are looked into
    rows = _loads(spark, root, schema).where(F.col(LOAD).startswith(load_id)).select(LOAD).distinct().collect()
    seen, name, n = {r[LOAD] for r in rows}, load_id, 1
    while name in seen:
        n += 1
        name = f"{load_id}-{n}"
    return name


def merge_into(spark: SparkSession, path: str, schema: StructType, source: DataFrame, keys, update_cols,
               insert_cols, time_col: str, partition_col: str, null_safe: bool = False) -> dict[str, int]:
    """Type-1 upsert of ``source`` into the Parquet table at ``path``.

    The table is partitioned by ``partition_col``, the date of ``time_col``,
    which is one of the keys. A source row can only match rows of its own date,
    so the table is read and rewritten only in the dates the source names (the
    driver learns these: at most one value per calendar day); all other
    partitions keep their files. Returns ``source, insert, update, copy``: the
    rows given and, of the rewritten partitions, the rows by what happened. A
    column ``_change`` that the table's schema has records the same per row.
    """
    if time_col not in keys:
        raise ValueError("the partition time must be a key")
    day = F.to_date(time_col)
    rows = source.groupBy(day.alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()
    if not rows:
        return {"source": 0, "insert": 0, "update": 0, "copy": 0}
    days: list[date] = [r.d for r in rows if r.d is not None]
    touched = F.col(partition_col).isin(days) if days else F.lit(False)
    if len(days) < len(rows):
        touched = touched | F.col(partition_col).isNull()
    target = (spark.read.schema(StructType([*schema.fields, StructField(partition_col, DateType())])).parquet(path)
              .where(touched).drop(partition_col, CHANGE_COL))
    merged = upsert_type1(target, source, keys, update_cols, insert_cols, null_safe=null_safe)
    seen = Observation()
    counted = merged.observe(seen, *[F.count(F.when(F.col(CHANGE_COL) == c, 1)).alias(c)
                                     for c in ("insert", "update", "copy")])
    replace_partitions(counted.select(*schema.fieldNames(), day.alias(partition_col)), path, partition_col)
    return {"source": sum(r.n for r in rows), **seen.get}

