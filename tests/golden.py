"""The nine golden rows of FIXTURES.md section 3 and their expected results."""

import datetime as dt

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("category", T.StringType()),
    T.StructField("category_pct", T.DoubleType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("institution", T.StringType()),
])


def _t(h, m):
    return dt.datetime(2016, 1, 1, h, m)


ROWS = [
    (1, "Pagto CARTÃO 1234", 10.0, "ALIM", 25.0, _t(5, 59), 100, "BANK_A"),
    (2, "pagto cartão 99", 20.0, "INDEFINIDO", 25.5, _t(12, 0), 101, "BANK_A"),
    (3, "12345", 5.0, "INDEFINIDO", 0.0, _t(18, 0), 100, "BANK_A"),
    (4, "Posto_X", 15.0, "TRANSP", 100.0, _t(6, 0), 100, "BANK_B"),
    (5, None, 7.0, "ALIM", 10.0, _t(10, 0), 100, "BANK_A"),
    (6, "Posto_X", None, "TRANSP", 10.0, _t(10, 0), 100, "BANK_A"),
    (7, "Posto_X", 1.0, None, 10.0, _t(10, 0), 100, "BANK_A"),
    (8, "posto_x", -5.0, "TRANSP", 101.0, _t(17, 59), 102, "BANK_B"),
    (None, "Posto_X", 1.0, "TRANSP", 10.0, _t(10, 0), 100, "BANK_A"),
]


def lines(spark):
    return spark.createDataFrame(ROWS, SCHEMA)
