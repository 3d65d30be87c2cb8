import pytest
from pyspark.sql import functions as F

from golden import lines
from linetally.sources import sinks
from linetally.sources.tables import scan


def test_append_twice(spark, scratch):
    df = lines(spark)
    path = f"{scratch}/out"
    assert sinks.append(df, path) and sinks.append(df, path)
    assert spark.read.parquet(path).count() == 2 * df.count()
    assert sinks.append(df, "") is False


def test_upsert_keeps_other_columns(spark, scratch):
    base = spark.createDataFrame([("a", 1, None), ("b", 2, None)], "text string, n int, flag int")
    base.write.parquet(f"{scratch}/base")
    upd = spark.createDataFrame([("a", 1), ("c", 1)], "text string, flag int")
    out = sinks.upsert(spark, f"{scratch}/base", upd, ["text"], f"{scratch}/out")
    got = {r["text"]: (r["n"], r["flag"]) for r in out.collect()}
    assert got == {"a": (1, 1), "b": (2, None), "c": (None, 1)}
    with pytest.raises(ValueError):
        sinks.upsert(spark, f"{scratch}/base", upd, ["text"], f"{scratch}/base")


def test_cleaned_export(spark, scratch):
    df = spark.createDataFrame([(1, "Olá 123"), (2, "99"), (3, None), (1, "zeta")], "id long, t string")
    sinks.export_cleaned_texts(df, "id", "t", f"{scratch}/exp")
    got = {r["id"]: r["text"] for r in spark.read.parquet(f"{scratch}/exp").collect()}
    assert got == {1: "zeta"}  # one per id (the greatest), empty and null texts skipped


def test_cleaned_export_null_id_fails(spark, scratch):
    df = spark.createDataFrame([(None, "abc")], "id long, t string")
    with pytest.raises(Exception):
        sinks.export_cleaned_texts(df, "id", "t", f"{scratch}/exp")


def test_cleaned_export_null_id_fails_beside_an_empty_text(spark, scratch):
    spark.createDataFrame([(None, None), (None, "123")], "id long, t string").write.parquet(f"{scratch}/in")
    for text in ("t IS NULL", "t = '123'"):
        rows = spark.read.parquet(f"{scratch}/in").where(text)
        with pytest.raises(Exception, match="null value in id column"):
            sinks.cleaned_texts(rows, "id", "t", one_per_id=False).collect()


def test_delimited_keeps_whole_texts(spark, scratch):
    texts = ["two\nlines", "crlf\r\nline", 'a "quoted" | bar', "back\\", '\\"', " blanks ", "", None, "\n", "x"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    sinks.export_delimited(df, f"{scratch}/csv")
    back = sinks.read_delimited(spark, f"{scratch}/csv", df.schema)
    assert [r["t"] for r in back.orderBy("id").collect()] == texts


def test_append_to_a_table_of_another_format(spark):
    df = spark.createDataFrame([(1, "a")], "id int, t string")
    for fmt in ("orc", "parquet"):
        df.write.format(fmt).mode("overwrite").saveAsTable(f"lt_append_{fmt}")
        assert sinks.append(df.select("t", "id"), f"lt_append_{fmt}")
        assert [tuple(r) for r in spark.table(f"lt_append_{fmt}").collect()] == [(1, "a")] * 2
        with pytest.raises(ValueError):
            sinks.append(df.select("id"), f"lt_append_{fmt}")
        spark.sql(f"DROP TABLE lt_append_{fmt}")


def test_upsert_rejects_repeated_update_keys(spark):
    old = spark.createDataFrame([("a", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 2), ("a", 3)], "k string, v int")
    with pytest.raises(Exception, match="several updates for one key"):
        sinks.upserted(old, new, ["k"]).collect()


def test_delimited_roundtrip(spark, scratch):
    df = lines(spark).where(F.col("row_id").isNotNull())
    sinks.export_delimited(df, f"{scratch}/csv")
    back = sinks.read_delimited(spark, f"{scratch}/csv", df.schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    first = spark.read.text(f"{scratch}/csv").collect()
    assert any(r[0].startswith("row_id|text|amount") for r in first)


def test_scan_fields_where_limit(spark, scratch):
    lines(spark).write.parquet(f"{scratch}/t")
    df = scan(spark, f"{scratch}/t", fields="row_id, amount", where="amount > 0", limit=2, order_by="row_id")
    assert df.columns == ["row_id", "amount"]
    # ascending order puts the null id first
    assert [r["row_id"] for r in df.collect()] == [None, 1]


def test_cleaned_export_skips_dedupe_for_unique_ids(spark):
    df = spark.createDataFrame([(1, "Olá"), (2, "x1")], "id long, t string")
    plan = sinks.cleaned_texts(df, "id", "t")._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan
    dup = spark.createDataFrame([(1, "a"), (1, "b")], "id long, t string")
    assert [tuple(r) for r in sinks.cleaned_texts(dup, "id", "t").collect()] == [(1, "b")]


def test_namespace_append_and_read(spark):
    from linetally.sources.tables import read_table

    spark.sql("CREATE DATABASE IF NOT EXISTS lt_ns")
    df = lines(spark).where(F.col("row_id").isNotNull())
    assert sinks.append(df, "lines_out", namespace="lt_ns")
    back = read_table(spark, "lines_out", namespace="lt_ns")
    assert back.count() == df.count()
    assert scan(spark, "lt_ns.lines_out", fields="row_id", where="row_id > 4").count() == 4


def test_scan_fields_with_expressions(spark, scratch):
    from linetally.sources.tables import split_fields

    assert split_fields("a, concat(b, ',', c) AS d,  e ") == ["a", "concat(b, ',', c) AS d", "e"]
    lines(spark).write.parquet(f"{scratch}/t")
    df = scan(spark, f"{scratch}/t", fields="row_id, concat_ws('-', category, institution) AS tag",
              where="row_id = 4")
    assert [tuple(r) for r in df.collect()] == [(4, "TRANSP-BANK_B")]


def test_upsert_composite_and_null_keys(spark):
    old = spark.createDataFrame([("a", 1, 10), ("a", None, 20), ("b", 2, 30)], "k1 string, k2 int, v int")
    new = spark.createDataFrame([("a", None, 21), ("c", 3, 40)], "k1 string, k2 int, v int")
    got = {tuple(r) for r in sinks.upserted(old, new, ["k1", "k2"]).collect()}
    # a null key part matches a null key part: ("a", None) is updated, not duplicated
    assert got == {("a", 1, 10), ("a", None, 21), ("b", 2, 30), ("c", 3, 40)}


def test_a_large_delimited_file_is_read_by_several_tasks(spark, scratch):
    hard = ["a\nb", "\r\n", "\\n", "\\", "\\s\\n", "x|y", 'q"q', '"', " pad ", "", None, "\x00", "é🙂", "\u2028", "#c", "\\N"]
    rows = [(i, hard[i % len(hard)] if i % 2 == 0 else f"{i} " + "long text\n" * 40) for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, text string")
    sinks.export_delimited(df.coalesce(1), f"{scratch}/one")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 * 1024))
    try:
        back = sinks.read_delimited(spark, f"{scratch}/one", df.schema)
        assert sorted(map(tuple, back.collect())) == sorted(rows)
        assert back.select(F.spark_partition_id().alias("p")).distinct().count() >= 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_times_come_back_whole(spark, scratch):
    df = spark.sql("SELECT timestamp_ntz'2024-02-03 04:05:06.123456' AS a, timestamp'2024-02-03 04:05:06.000001' AS b, 0.1D AS c, 1e-300D AS d")
    sinks.export_delimited(df, f"{scratch}/times")
    assert sinks.read_delimited(spark, f"{scratch}/times", df.schema).collect() == df.collect()
