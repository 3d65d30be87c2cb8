import __spark_entry__ as E
from linetally.schema import PROFILE_COLUMNS


def test_every_query_has_an_oracle():
    optional = set() if E.llm_queries is None else {*E.llm_queries.queries(), "pipeline"}
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(E.queries()) - set(E.oracle_sql()) <= optional


def test_entry_runs(spark):
    df = E.entry(spark)
    assert tuple(df.columns) == PROFILE_COLUMNS
    assert df.count() > 0
