from pyspark.sql import functions as F

from golden import lines
from linetally.operators import profile as prof
from linetally.operators.idlists import text_id_chunks
from linetally.operators.report import text_report
from linetally.schema import LineColumns
from linetally.sources import fixtures

SF = "/root/testdata/sf0.001"


class CentColumns(LineColumns):
    amount_type = "decimal(18,2)"


CENTS = CentColumns()  # exact sums: equal whatever the order of partitions


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_report_matches_separate_operators_on_golden(spark):
    rep = text_report(lines(spark), span=4)
    assert _rows(rep.profile(compat=True)) == _rows(prof.text_profile(lines(spark), compat=True))
    assert _rows(rep.totals()) == _rows(prof.text_totals(lines(spark)))
    joined = {}
    for r in rep.id_chunks().orderBy("text", "chunk", "part").collect():
        joined.setdefault(r["text"], []).append(r["row_ids"])
    assert {t: "|".join(v) for t, v in joined.items()} == {"pagto cartão": "1|2", "posto_x": "4|8"}


def test_report_matches_on_test_tables_with_many_chunks(spark):
    lines_df = fixtures.statement_lines(spark, SF)
    rep = text_report(lines_df, CENTS, span=37)
    assert _rows(rep.profile(compat=False)) == _rows(prof.text_profile(lines_df, CENTS, compat=False))
    assert _rows(rep.id_chunks()) == _rows(text_id_chunks(lines_df, span=37))


def test_report_scans_source_once(spark, scratch):
    lines(spark).write.parquet(f"{scratch}/lines")
    rep = text_report(spark.read.parquet(f"{scratch}/lines"))
    for df in (rep.profile(), rep.totals(), rep.id_chunks()):
        assert f"{scratch}/lines" not in df._jdf.queryExecution().executedPlan().toString()


def test_report_ids_when_ids_repeat(spark):
    df = lines(spark)
    dup = df.unionByName(df.where("row_id = 1"))  # row 1 twice under the same text
    rep = text_report(dup, span=4)
    assert _rows(rep.id_chunks()) == _rows(text_id_chunks(dup, span=4))
    joined = "|".join(r["row_ids"] for r in rep.id_chunks().where("text = 'pagto cartão'").orderBy("chunk", "part").collect())
    assert joined == "1|1|2"


def test_report_of_repeated_ids_on_test_tables(spark):
    lines_df = fixtures.statement_lines(spark, SF).withColumn("row_id", F.when(F.col("row_id") % 3 == 0, 7).otherwise(F.col("row_id")))
    rep = text_report(lines_df, CENTS, span=5)
    assert _rows(rep.profile(compat=True)) == _rows(prof.text_profile(lines_df, CENTS, compat=True))
    assert _rows(rep.id_chunks()) == _rows(text_id_chunks(lines_df, CENTS, span=5))


def test_report_plans(spark, scratch):
    """One hash aggregate over the input, and a profile that reads the written groups."""
    lines(spark).write.parquet(f"{scratch}/lines")
    lazy = text_report(spark.read.parquet(f"{scratch}/lines"), materialize=False)
    plan = lazy.fine._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "HashAggregate" in plan and "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    profile = text_report(spark.read.parquet(f"{scratch}/lines")).profile()._jdf.queryExecution().executedPlan().toString()
    assert "keys=[text" not in profile  # the groups are read, not made again
