import pytest

from golden import lines
from linetally.operators.extract import filter_predicate, filter_rows


def test_in_on_string_and_numeric(spark):
    df = lines(spark)
    got = sorted((r["row_id"] for r in filter_rows(df, "category", "in", ["TRANSP"]).collect()), key=lambda x: (x is None, x))
    assert got == [4, 6, 8, None]
    got = sorted(r["row_id"] for r in filter_rows(df, "row_id", "in", ["1", "3"]).collect())
    assert got == [1, 3]


def test_greater_and_between(spark):
    df = lines(spark)
    assert sorted(r["row_id"] for r in filter_rows(df, "amount", "greater", ["10"]).collect()) == [2, 4]
    got = sorted(r["row_id"] for r in filter_rows(df, "category_pct", "between", ["25", "100"]).collect())
    assert got == [1, 2, 4]


def test_errors(spark):
    df = lines(spark)
    with pytest.raises(ValueError):
        filter_predicate(df, "amount", "bogus", ["1"])
    with pytest.raises(ValueError):
        filter_predicate(df, "amount", "greater", None)
    with pytest.raises(ValueError):
        filter_predicate(df, "amount", "between", ["1"])


def test_filters_pushed_to_parquet(spark, scratch):
    lines(spark).write.parquet(f"{scratch}/lines")
    df = spark.read.parquet(f"{scratch}/lines")
    for kind, col, vals, token in [
        ("in", "category", ["TRANSP", "ALIM"], "In(category"),
        ("greater", "amount", ["10"], "GreaterThan(amount"),
        ("between", "category_pct", ["25", "50"], "GreaterThanOrEqual(category_pct"),
    ]:
        plan = filter_rows(df, col, kind, vals)._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters" in plan and token in plan, plan
