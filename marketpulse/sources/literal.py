"""Small literal tables built on the JVM side.

``createDataFrame`` on Python rows plans a Python-RDD scan, so every query
touching such a frame starts Python workers. Literal rows are instead given
to a parameterised SQL ``VALUES`` list: a local relation with exact size
statistics, no Python in the plan, and no quoting of the values by hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def literal_frame(spark: SparkSession, rows, schema: StructType) -> DataFrame:
    fields = schema.fields
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    args, tuples = {}, []
    for i, row in enumerate(rows):
        names = []
        for j, value in enumerate(row):
            args[f"v{i}_{j}"] = value
            names.append(f":v{i}_{j}")
        tuples.append("(" + ", ".join(names) + ")")
    cols = ", ".join(f"c{j}" for j in range(len(fields)))
    select = ", ".join(f"CAST(c{j} AS {f.dataType.simpleString()}) AS `{f.name}`"
                       for j, f in enumerate(fields))
    return spark.sql(f"SELECT {select} FROM VALUES {', '.join(tuples)} AS t({cols})", args=args)
