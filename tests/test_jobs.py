import os

from pyspark.sql import functions as F

from golden import lines
from linetally.session import Scratch
from linetally.sources import sinks
from linetally.plans.jobs import Source, count_job, export_job, extract_job, pareto_job, profile_job


def _write_lines(spark, scratch):
    path = f"{scratch}/lines"
    lines(spark).write.parquet(path)
    return path


def test_count_job_with_where_and_limit(spark, scratch):
    path = _write_lines(spark, scratch)
    assert count_job(spark, Source(path)).collect()[0]["row_count"] == 9
    assert count_job(spark, Source(path, where="amount > 5")).collect()[0]["row_count"] == 4
    assert count_job(spark, Source(path, limit=3, order_by="row_id")).collect()[0]["row_count"] == 3


def test_profile_job_appends_and_returns_totals(spark, scratch):
    path = _write_lines(spark, scratch)
    out = f"{scratch}/profile_out"
    res = profile_job(spark, Source(path), output_table=out)
    assert res.totals.collect()[0]["total_count"] == 5
    back = spark.read.parquet(out)
    assert sorted(r["text"] for r in back.collect()) == ["pagto cartão", "posto_x"]
    # projection and predicate of the source reach the profile
    res2 = profile_job(spark, Source(path, fields="row_id, text, amount, category, category_pct, ts",
                                     where="row_id <> 2"))
    assert {r["text"]: r["count"] for r in res2.profile.collect()} == {"pagto cartão": 1, "posto_x": 2}


def test_extract_job_writes_table_and_delimited(spark, scratch):
    path = _write_lines(spark, scratch)
    rows = extract_job(spark, Source(path), "amount", "between", ["5", "15"],
                       output_table=f"{scratch}/ext", delimited_path=f"{scratch}/ext_csv")
    want = sorted(r["row_id"] for r in rows.collect())
    assert want == [1, 3, 4, 5]  # row 5 has a null text but an amount of 7.0
    assert sorted(r["row_id"] for r in spark.read.parquet(f"{scratch}/ext").collect()) == want
    csv = spark.read.option("sep", "|").option("header", True).csv(f"{scratch}/ext_csv")
    assert sorted(int(r["row_id"]) for r in csv.collect()) == want


def test_export_job(spark, scratch):
    path = _write_lines(spark, scratch)
    export_job(spark, Source(path, where="row_id IS NOT NULL"), "row_id", "text", f"{scratch}/exp", fmt="json")
    got = {r["id"]: r["text"] for r in spark.read.json(f"{scratch}/exp").collect()}
    assert got == {1: "pagto cartão", 2: "pagto cartão", 4: "posto_x", 6: "posto_x", 7: "posto_x", 8: "posto_x"}


def test_pareto_job(spark, scratch):
    path = _write_lines(spark, scratch)
    report = pareto_job(spark, Source(path), share=1.0, output_table=f"{scratch}/flags")
    assert report.n == 3  # the empty text counts in U but is never selected
    flags = spark.read.parquet(f"{scratch}/flags")
    assert flags.where(F.col("pareto_amount") == 1).count() == 2


def test_outputs_of_an_extract_hold_the_same_rows_and_leave_nothing(spark, scratch):
    """An unordered limit over many partitions, read three times; the owner deletes the copy."""
    rows = spark.range(20_000).selectExpr("id AS row_id", "cast(id AS double) AS amount", "concat('line\n', id, ' \\\\ ', id) AS text")
    rows.repartition(13).write.parquet(f"{scratch}/lines")
    with Scratch(spark) as owner:
        source = Source(f"{scratch}/lines", where="rand() < 0.5", limit=700)
        got = extract_job(spark, source, "amount", "greater", ["100"], output_table=f"{scratch}/t", delimited_path=f"{scratch}/d")
        want = sorted(map(tuple, got.collect()))
        assert len(want) > 500
        assert sorted(map(tuple, spark.read.parquet(f"{scratch}/t").collect())) == want
        assert sorted(map(tuple, sinks.read_delimited(spark, f"{scratch}/d", got.schema).collect())) == want
        folders = [p.removeprefix("file:") for p in owner.paths]
        assert folders and all(os.path.isdir(p) for p in folders)
    assert not any(os.path.exists(p) for p in folders) and owner.paths == []
