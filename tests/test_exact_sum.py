"""Exact sums of doubles against ``math.fsum``, which rounds the exact sum once."""

import math
import random

import pytest
from pyspark.sql import functions as F

from linetally.functions import exact_sum


def _bits(x):
    return x.hex() if x else (0.0).hex()


def _groups(seed, n=40):
    r = random.Random(seed)
    out = {}
    for g in range(n):
        kind = g % 8
        if kind == 0:
            values = [round(r.uniform(-500, 500), 2) for _ in range(r.randrange(1, 300))]
        elif kind == 1:
            values = [r.uniform(-1, 1) * 10.0 ** r.randrange(-300, 300) for _ in range(r.randrange(1, 60))]
        elif kind == 2:  # what is left after big amounts cancel
            values = [1e16, 0.1, -1e16, 1e-9, 3.0, -3.0]
        elif kind == 3:
            values = [5e-324, 2.2e-308, -5e-324, 1e-310] * r.randrange(1, 9)
        elif kind == 4:  # ties and powers of two
            values = [2.0**53, 1.0, 2.0**-60 * r.choice([0, 1])] + [2.0**k for k in range(-81, 60, 27)]
        elif kind == 5:
            values = [0.0, -0.0]
        elif kind == 6:
            values = [-x for x in [2.0**54, 2.0**-29, 2.0**-30, 2.0**55, 1.5]] * r.randrange(1, 5)
        else:
            values = [1.7e308, -1.7e308, 1e300, r.uniform(-1, 1), None]
        out[g] = values
    return out


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_sums_are_correctly_rounded_on_any_partitioning(spark, partitions):
    groups = _groups(1)
    rows = [(g, x) for g, values in groups.items() for x in values]
    random.Random(partitions).shuffle(rows)
    df = spark.createDataFrame(rows, "g int, x double").repartition(partitions)
    got = {r["g"]: r["s"] for r in exact_sum.sum_doubles(df, ["g"], "x", "s").collect()}
    want = {g: math.fsum(x for x in values if x is not None) for g, values in groups.items()}
    assert {g: _bits(x) for g, x in got.items()} == {g: _bits(x) for g, x in want.items()}


def test_totals_of_totals_lose_nothing(spark):
    """Exact group sums add up to the exact sum of all, not to the sum of rounded ones."""
    rows = [(g % 7, x) for g, values in _groups(2).items() if g % 8 != 7 for x in values]
    df = spark.createDataFrame(rows, "g int, x double")
    by_key = exact_sum.with_digits(df, "x", "_x").groupBy("g", "_xk").agg(*exact_sum.sums("_x"))
    groups = exact_sum.with_total(by_key.groupBy("g").agg(exact_sum.pairs("_xk", "_x").alias("_p")), "_p", "s", "_exact")
    again = groups.select(F.explode("_exact").alias("e")).select("e.p", "e.d").groupBy("p").agg(F.sum("d").alias("d"))
    total = exact_sum.with_total(again.agg(F.collect_list(F.struct(F.col("p"), F.col("d"))).alias("_p")), "_p", "t").first()["t"]
    assert _bits(total) == _bits(math.fsum(x for _, x in rows))


def test_split_gives_the_number_back(spark):
    r = random.Random(4)
    values = [r.uniform(-1, 1) * 2.0 ** r.randrange(-1070, 1023) for _ in range(500)] + [2.0**k for k in range(-1074, 1024, 7)] + [0.0]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    for row in exact_sum.with_digits(df, "x", "_d").collect():
        parts = [math.ldexp(row[f"_d{i}"], 27 * (row["_dk"] - i)) for i in range(5) if row[f"_d{i}"]]
        assert math.fsum(parts) == row["x"] and all(abs(row[f"_d{i}"]) <= 2**28 for i in range(5))


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_window_sums_and_their_totals(spark, partitions):
    r = random.Random(7)
    rows = [(i % 9, r.choice([round(r.uniform(-900, 900), 2), r.uniform(-1, 1) * 2.0 ** r.randrange(-50, 107), 0.0, 2.0**-56, -(2.0**107)])) for i in range(4000)]
    rows += [(9, -0.0), (10, 1e16), (10, 1.0), (10, -1e16)]
    df = exact_sum.windowed(spark.createDataFrame(rows, "g int, x double").repartition(partitions), "x", "_x")
    groups = exact_sum.with_window_total(df.groupBy("g").agg(*exact_sum.window_sums("_x")), "_x", "s", "e")
    assert {x["g"]: _bits(x["s"]) for x in groups.collect()} == {g: _bits(math.fsum(x for k, x in rows if k == g)) for g in range(11)}
    whole = exact_sum.with_totals_of_totals(groups.agg(*exact_sum.total_sums("e", "_t")), {"_t": "t"})
    assert _bits(whole.first()["t"]) == _bits(math.fsum(x for _, x in rows))
    with pytest.raises(Exception, match="outside the range"):
        exact_sum.windowed(spark.createDataFrame([(1e200,)], "x double"), "x", "_x").collect()


def test_nothing(spark):
    df = spark.createDataFrame([], "g int, x double")
    assert exact_sum.sum_doubles(df, ["g"], "x", "s").count() == 0
    assert [r["s"] for r in exact_sum.sum_doubles(df, [], "x", "s").collect()] == [0.0]
    nulls = spark.createDataFrame([(1, None)], "g int, x double")
    assert [r["s"] for r in exact_sum.sum_doubles(nulls, ["g"], "x", "s").collect()] == [0.0]
