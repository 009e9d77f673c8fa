"""K1-K4 helpers and version lists."""

import datetime as dt

from pyspark.sql import functions as F

from regflat.functions.strings import base_name, day_names, last_chars, padded_numbers, strip_zip


def test_string_helpers(spark):
    df = spark.createDataFrame([("file:/a/b/WEEKLY_2019-10-05.zip",), ("/x/table.parquet/",), ("c.zip.zip",)],
                               "p string")
    got = df.select(base_name(F.col("p")), last_chars(strip_zip(F.col("p")), 3)).collect()
    assert [tuple(r) for r in got] == [("WEEKLY_2019-10-05", "-05"), ("table", "et/"), ("c.zip", "zip")]


def test_day_names_half_open(spark):
    df = spark.createDataFrame([(dt.date(2019, 12, 30), dt.date(2020, 1, 2)), (dt.date(2020, 1, 2), dt.date(2020, 1, 2))],
                               "s date, e date")
    got = [r[0] for r in df.select(day_names(F.col("s"), F.col("e"))).collect()]
    assert got == [["191230", "191231", "200101"], []]
    assert df.limit(1).select(padded_numbers(F.lit(3))).first()[0] == ["01", "02", "03"]
