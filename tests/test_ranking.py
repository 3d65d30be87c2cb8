import random

from pyspark.sql import functions as F

from linetally.operators.pareto import selection_size
from linetally.operators.ranking import rank_rows


def test_rank_is_exact_global_order(spark):
    rnd = random.Random(3)
    rows = [(f"t{i:05d}", float(rnd.randint(0, 40))) for i in range(3000)]
    df = spark.createDataFrame(rows, "text string, v double").repartition(13)
    r = rank_rows(df, [F.col("v").desc(), F.col("text").asc()], "rank", "test-rank")
    got = {x["text"]: x["rank"] for x in r.frame.collect()}
    want = {t: i + 1 for i, (t, _) in enumerate(sorted(rows, key=lambda x: (-x[1], x[0])))}
    assert r.total == len(rows)
    assert got == want


def test_rank_plan_has_no_single_partition(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("text"), (F.col("id") % 7).alias("v"))
    r = rank_rows(df, [F.col("v").desc(), F.col("text")], "rank", "test-rank-plan")
    plan = r.frame._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_selection_size():
    assert selection_size(3, 0.2) == 1
    assert selection_size(382, 0.2) == 77
    assert selection_size(0, 0.2) == 0
    assert all(selection_size(u, 0.2) == -(-u // 5) for u in range(1, 20000))
