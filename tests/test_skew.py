"""One text holding a third of all rows: results stay whole and exact, and
no step puts the hot text's rows into one task or one cell."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from golden import SCHEMA
from linetally.operators import profile as prof
from linetally.operators.idlists import text_id_chunks
from linetally.operators.pareto import pareto

N = 30000


@pytest.fixture(scope="module")
def skewed(spark):
    ts = dt.datetime(2024, 1, 1)
    df = spark.range(N).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT text 1")).otherwise(F.concat(F.lit("t "), F.translate((F.col("id") % 997).cast("string"), "0123456789", "abcdefghij"))).alias("text"),
        (F.col("id") % 100 / 10).cast("double").alias("amount"),
        F.when(F.col("id") % 7 == 0, F.lit("INDEFINIDO")).otherwise(F.lit("C")).alias("category"),
        (F.col("id") % 101).cast("double").alias("category_pct"),
        (F.lit(ts) + F.make_interval(hours=(F.col("id") % 24).cast("int"))).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 50).alias("user_id"),
        F.lit("I").alias("institution"),
    )
    return spark.createDataFrame(df.rdd, SCHEMA).repartition(16)


def test_hot_text_totals_are_whole(skewed):
    rows = {r["text"]: r for r in prof.text_profile(skewed).collect()}
    hot = rows["hot text"]
    assert hot["count"] == N // 3
    t = prof.text_totals(skewed).collect()[0]
    assert t["total_count"] == N
    assert sum(r["count"] for r in rows.values()) == N  # no empty texts in this data
    # the representative row of the hot text is its least id, 0
    assert hot["category"] == "INDEFINIDO" and hot["category_percentual_quartil"] == 0


def test_hot_text_ids_spread_over_chunks_and_tasks(spark, skewed):
    span = 256
    chunks = text_id_chunks(skewed, span=span).where(F.col("text") == "hot text")
    stats = chunks.agg(F.count("*").alias("n"), F.max("n_ids").alias("mx"), F.sum("n_ids").alias("tot")).collect()[0]
    assert stats["tot"] == N // 3
    assert stats["mx"] <= span
    assert stats["n"] >= (N // 3) // span
    # AQE would merge these small partitions; switch that off to see the hash layout.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = chunks.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert tasks >= 4


def test_pareto_with_hot_text(skewed):
    p = pareto(prof.grouped(skewed))
    first = p.selection("count").orderBy("rank").first()
    assert first["text"] == "hot text" and first["rank"] == 1
    assert p.selection("count").count() == p.n
