import datetime as dt

import pytest
from pyspark.sql import functions as F

from linetally.functions.buckets import (
    hour_of_day, is_dia, is_madrugada, is_noite, is_tarde, parse_double, percentage_bucket,
)


def test_bucket_bounds(spark):
    vals = [-1.0, 0.0, 0.001, 25.0, 25.5, 50.0, 50.1, 75.0, 99.9, 100.0, 100.5, 101.0, float("nan"), None]
    want = [0, 0, 1, 1, 2, 2, 3, 3, 4, 4, 0, 0, 0, 0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, p double")
    got = [r["b"] for r in df.select("i", percentage_bucket("p").alias("b")).orderBy("i").collect()]
    assert got == want


def test_parse_double_strict_and_lenient(spark):
    df = spark.createDataFrame([("12.5",), ("x",)], "s string")
    lenient = [r[0] for r in df.select(parse_double("s", strict=False)).collect()]
    assert lenient == [12.5, None]
    with pytest.raises(Exception):
        df.select(parse_double("s", strict=True)).collect()


@pytest.mark.parametrize("hour,parts", [
    (0, "m"), (5, "m"), (6, "d"), (11, "d"), (12, "t"), (17, "t"), (18, "n"), (23, "n"),
])
def test_day_parts(spark, hour, parts):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, hour, 30),)], "ts timestamp_ntz")
    h = hour_of_day("ts")
    r = df.select(
        is_madrugada(h).alias("m"), is_dia(h).alias("d"), is_tarde(h).alias("t"),
        is_noite(h, compat=False).alias("n"), is_noite(h, compat=True).alias("nc"),
    ).collect()[0]
    assert [k for k in "mdtn" if r[k]] == [parts]
    assert r["nc"] == (parts != "t")  # compatible night: every hour outside [12, 18)


def test_hour_zone_free_for_ntz(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 59),)], "ts timestamp_ntz")
    assert df.select(F.hour("ts")).collect()[0][0] == 23
