"""Keyed tables: partial rewrites, snapshots, and the row-level rules of an upsert."""

import os
import re

import pytest
from pyspark.sql import functions as F

from linetally.sources.keyed import KeyedTable
from linetally.sources.sinks import upserted


def _files(path):
    return {os.path.join(d, f) for d, _, files in os.walk(f"{path}/data") for f in files if f.endswith(".parquet")}


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_an_update_rewrites_only_the_buckets_it_touches(spark, scratch):
    rows = spark.range(20_000).selectExpr("id AS k", "concat('t', id) AS t", "id * 2 AS n")
    path = f"{scratch}/keyed"
    table = KeyedTable.create(rows, path, ["k"], buckets=64)
    before = _files(path)
    assert len(before) == 64  # one file a bucket
    updates = spark.createDataFrame([(5, 1), (17, 2), (30_000, 3)], "k long, flag int")
    touched = table.upsert(updates)
    written = _files(path) - before
    assert 1 <= len(touched) <= 3 and len(written) == len(touched) and before <= _files(path)
    assert _rows(table.read()) == _rows(upserted(rows, updates, ["k"]))
    assert _rows(table.read(1)) == _rows(rows)


def test_readers_keep_their_version_and_a_dead_writer_leaves_no_trace(spark, scratch):
    rows = spark.range(500).selectExpr("id AS k", "id AS n")
    table = KeyedTable.create(rows, f"{scratch}/keyed", ["k"], buckets=8)
    reader = table.read()
    table.upsert(rows.where("k < 100").withColumn("n", F.lit(-1).cast("long")))
    assert _rows(reader) == _rows(rows) and table.read().where("n = -1").count() == 100
    # a generation without a snapshot: its writer died before it could publish
    live = table._snapshot()[1]
    table._write(rows.limit(5).withColumn("_bucket", F.lit(0)), 99)
    assert table._snapshot()[1] == live and table.read().count() == 500
    assert KeyedTable(spark, f"{scratch}/keyed").versions() == [1, 2]


def test_only_touched_buckets_are_read(spark, scratch):
    rows = spark.range(5_000).selectExpr("id AS k", "id AS n")
    table = KeyedTable.create(rows, f"{scratch}/keyed", ["k"], buckets=50)
    found = table.lookup(spark.createDataFrame([(7,), (7,), (4_999,), (-1,)], "k int"))
    assert sorted(r["k"] for r in found.collect()) == [7, 4999]
    scan = next(x for x in found._jdf.queryExecution().executedPlan().toString().split("\n") if "PartitionFilters" in x)
    assert re.search(r"PartitionFilters: \[.*_bucket#\d+ (IN|INSET)", scan)


def test_keys_nulls_and_types(spark, scratch):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", None, "y"), (None, 1, "z"), (None, None, None)], "p string, q long, v string")
    table = KeyedTable.create(rows, f"{scratch}/keyed", ["p", "q"], buckets=3)
    updates = spark.createDataFrame([("a", None, "new"), (None, None, "null key"), ("b", 1, None)], "p string, q int, v string")
    table.upsert(updates)
    assert {tuple(r) for r in table.read().collect()} == {("a", 1, "x"), ("a", None, "new"), (None, 1, "z"), (None, None, "null key"), ("b", 1, None)}
    table.upsert(spark.createDataFrame([("a", 1, None)], "p string, q long, v string"))  # a null is a value to set
    assert table.read().where("p = 'a' AND q = 1").first()["v"] is None


def test_columns_that_updates_add(spark, scratch):
    rows = spark.range(100).selectExpr("id AS k", "'old' AS v")
    table = KeyedTable.create(rows, f"{scratch}/keyed", ["k"], buckets=10)
    first = spark.createDataFrame([(1, 1)], "k long, amount_flag int")
    second = spark.createDataFrame([(1, 9), (2, 2)], "k long, count_flag int")
    table.upsert(first)
    table.upsert(second)
    assert _rows(table.read()) == _rows(upserted(upserted(rows, first, ["k"]), second, ["k"]))
    assert table.upsert(first.limit(0)) == [] and table.versions() == [1, 2, 3]


def test_repeated_keys_fail_before_anything_is_written(spark, scratch):
    rows = spark.range(10).selectExpr("id AS k", "id AS n")
    table = KeyedTable.create(rows, f"{scratch}/keyed", ["k"], buckets=2)
    with pytest.raises(ValueError, match="several rows"):
        table.upsert(rows.unionByName(rows))
    with pytest.raises(ValueError, match="several rows"):
        KeyedTable.create(rows.unionByName(rows), f"{scratch}/other", ["k"], buckets=2)
    with pytest.raises(ValueError, match="columns"):
        table.upsert(rows.drop("k"))
    assert table.versions() == [1] and not os.path.exists(f"{scratch}/other")


def test_vacuum_deletes_what_no_version_needs(spark, scratch):
    rows = spark.range(50).selectExpr("id AS k", "id AS n")
    table = KeyedTable.create(rows, f"{scratch}/keyed", ["k"], buckets=4)
    table.upsert(rows.withColumn("n", F.col("n") + 1))
    want = _rows(table.read())
    assert table.vacuum() == [1] and _rows(table.read()) == want and len(_files(f"{scratch}/keyed")) == 4
