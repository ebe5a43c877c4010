from datetime import date

from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from marketpulse.sources.literal import literal_frame

SCHEMA = StructType([StructField("n", LongType()), StructField("s", StringType()), StructField("d", DateType())])


def test_literal_frame_values_survive(spark):
    rows = [(1, "it's \"quoted\"", date(2021, 12, 2)), (2, "back\\slash; DROP", None),
            (None, "ünïcode — ok", date(1970, 1, 1)), (4, None, None)]
    df = literal_frame(spark, rows, SCHEMA)
    assert df.schema.simpleString() == SCHEMA.simpleString()
    assert sorted(df.collect(), key=lambda r: (r.n is None, r.n)) == \
        sorted([tuple(r) for r in rows], key=lambda r: (r[0] is None, r[0]))


def test_literal_frame_empty(spark):
    df = literal_frame(spark, [], SCHEMA)
    assert df.count() == 0 and df.schema.simpleString() == SCHEMA.simpleString()
