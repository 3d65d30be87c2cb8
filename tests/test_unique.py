"""Uniqueness of ids: by the order of the splits, or by counting where they overlap."""

import random

from pyspark.sql import functions as F

from linetally.operators import unique


def test_ordered_ids_are_not_shuffled(spark, scratch, monkeypatch):
    spark.range(50_000).withColumn("t", F.lit("x")).write.parquet(f"{scratch}/t")
    df = spark.read.parquet(f"{scratch}/t")
    plan = unique.stretches(df, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "t:string" not in plan
    counted = []
    monkeypatch.setattr(unique, "_within", lambda shared, c: counted.append(shared) or F.lit(True))
    assert unique.ids_unique(df, "id") and counted == []


def test_overlaps():
    assert unique.overlaps([(1, 5), (6, 9), (10, 10)]) == []
    assert unique.overlaps([(1, 5), (5, 9)]) == [(5, 5)]
    assert unique.overlaps([(1, 9), (2, 3), (4, 5), (8, 20), (19, 30)]) == [(2, 3), (4, 5), (8, 9), (19, 20)]
    r = random.Random(1)
    for _ in range(300):
        spans = [tuple(sorted((r.randrange(40), r.randrange(40)))) for _ in range(r.randrange(6))]
        shared = {x for x in range(40) if sum(a <= x <= b for a, b in spans) > 1}
        got = unique.overlaps(spans)
        assert {x for a, b in got for x in range(a, b + 1)} >= shared
        assert all(b < c for (_, b), (c, _) in zip(got, got[1:]))


def test_all_cases_equal_counting(spark, monkeypatch):
    monkeypatch.setattr(unique, "MAX_OVERLAPS", 2)
    r = random.Random(2)
    for trial in range(14):
        ids = list(range(300)) if trial % 2 else r.sample(range(10**6), 300)
        if trial % 3 == 0:
            ids[r.randrange(300)] = ids[r.randrange(300)]
        if trial % 5 == 0:
            r.shuffle(ids)
        values = [f"é{i}" if trial >= 7 else i for i in ids] + [None] * (trial % 4 // 3)
        kind = "string" if trial >= 7 else "long"
        df = spark.createDataFrame([(v, 1) for v in values], f"k {kind}, n int").repartition(1 + trial % 6) if trial % 4 else spark.createDataFrame([(v, 1) for v in values], f"k {kind}, n int")
        assert unique.ids_unique(df, "k") == (len(set(values)) == len(values)), trial


def test_nulls_and_nothing(spark):
    df = spark.createDataFrame([(None,), (1,)], "k long")
    assert unique.ids_unique(df, "k") and not unique.ids_unique(df.unionByName(df.where("k IS NULL")), "k")
    assert unique.ids_unique(df.limit(0), "k")
