"""The operators take their column names from LineColumns: the golden rows
under the column names of the original table give the same results."""

from pyspark.sql import functions as F

from golden import lines
from linetally.operators import profile as prof
from linetally.operators.clients import client_report
from linetally.operators.idlists import text_id_chunks
from linetally.operators.report import text_report
from linetally.plans.jobs import Source, pareto_job, profile_job
from linetally.schema import LineColumns

ORIGINAL = LineColumns(row_id="row_id", text="rsegda_lin_extrt", amount="event_amt", category="category",
                       category_pct="category_percentual", ts="event_start_dt", user_id="id",
                       institution="financial_institution")


def _renamed(spark):
    df = lines(spark)
    default = LineColumns()
    return df.select(*[F.col(getattr(default, f)).alias(getattr(ORIGINAL, f)) for f in default.__dataclass_fields__])


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_same_results_under_other_column_names(spark, scratch):
    df = _renamed(spark)
    assert _rows(prof.text_profile(df, ORIGINAL)) == _rows(prof.text_profile(lines(spark)))
    assert _rows(prof.text_totals(df, ORIGINAL)) == _rows(prof.text_totals(lines(spark)))
    assert _rows(text_id_chunks(df, ORIGINAL)) == _rows(text_id_chunks(lines(spark)))
    assert _rows(text_report(df, ORIGINAL).profile()) == _rows(prof.text_profile(lines(spark)))
    assert _rows(client_report(df, ORIGINAL)[0]) == _rows(client_report(lines(spark))[0])
    df.write.parquet(f"{scratch}/event_cc")
    res = profile_job(spark, Source(f"{scratch}/event_cc", where="event_amt > 0"), ORIGINAL)
    assert {r["text"]: r["count"] for r in res.profile.collect()} == {"pagto cartão": 2, "posto_x": 1}
    assert pareto_job(spark, Source(f"{scratch}/event_cc"), ORIGINAL).selection("amount").count() == 1
