"""The head of an order by refinement, against sorting."""

import random

import pytest
from pyspark.sql import functions as F

from golden import lines
from linetally.operators import cut
from linetally.operators import profile as prof
from linetally.operators.pareto import pareto


def _values(kind, r):
    if kind == "ties":
        return [float(r.randrange(4)) for _ in range(900)]
    if kind == "one value":
        return [0.125] * 900
    if kind == "spread":  # far apart, of both signs, and next to each other
        return [r.choice([-1, 1]) * 10.0 ** r.randrange(-200, 200) for _ in range(600)] + [1.0 + k * 2.0**-52 for k in range(300)]
    return [r.choice([None, float(r.randrange(3)), None]) for _ in range(900)]


@pytest.mark.parametrize("kind", ["ties", "one value", "spread", "nulls"])
def test_head_equals_sorting(spark, kind):
    r = random.Random(3)
    texts = list({r.choice(["", "same long prefix of all these texts ", "é", "z"]) + "".join(r.choice("abé_ ") for _ in range(r.randrange(1, 20))) for _ in range(2500)})[:900]
    rows = list(zip(texts, _values(kind, r)))
    df = spark.createDataFrame(rows, "t string, v double").repartition(5)
    order = sorted(rows, key=lambda x: (x[1] is None, -(x[1] or 0.0), x[0].encode()))
    for n in (0, 1, 179, 450, len(rows) - 1, len(rows), 5000):
        got = {x["t"] for x in df.where(cut.head(df, "v", "t", n)).collect()}
        assert got == {t for t, _ in order[:n]}, n


def test_nothing(spark):
    df = spark.createDataFrame([], "t string, v double")
    assert df.where(cut.head(df, "v", "t", 3)).count() == 0


def test_flags_and_summary_need_no_sort(spark):
    report = pareto(prof.grouped(lines(spark)), 0.34)
    for df in (report.flags(), report.summary()):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan and "Sort " not in plan and "Window" not in plan
    for by in ("amount", "count"):
        assert {r["text"] for r in report.selection(by).collect()} == {r["text"] for r in report.flags().where(F.col(f"pareto_{by}") == 1).collect()}
