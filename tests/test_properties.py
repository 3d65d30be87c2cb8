"""Properties of the profile and the Pareto report on the sf0.01 test tables."""

import math

import pytest
from pyspark.sql import functions as F

from linetally.operators import profile as prof
from linetally.operators.idlists import text_id_chunks
from linetally.operators.pareto import pareto
from linetally.sources import fixtures

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def report(spark):
    lines = fixtures.statement_lines(spark, SF)
    groups = prof.grouped(lines)
    return {
        "lines": lines,
        "groups": groups,
        "totals": prof.totals_from_groups(groups).collect()[0],
        "compat": prof.profile_from_groups(groups, compat=True).collect(),
        "fixed": prof.profile_from_groups(groups, compat=False).collect(),
        "pareto": pareto(groups),
    }


def test_group_counts_sum_to_totals(report):
    t = report["totals"]
    assert sum(r["count"] for r in report["compat"]) == t["total_count"]  # no empty text here
    assert t["unique_texts"] == len(report["compat"]) == 382
    assert t["categorised_count"] + t["undefined_count"] == t["total_count"]
    assert sum(r["percentual_count"] for r in report["compat"]) == pytest.approx(1.0)
    assert sum(r["percentual_amount"] for r in report["compat"]) == pytest.approx(1.0)


def test_day_parts(report):
    for r in report["compat"]:
        assert r["count_noite"] + r["count_tarde"] == r["count"]
        assert r["percentual_madrugada"] == r["percentual_dia"]
    for r in report["fixed"]:
        assert r["count_dia"] + r["count_tarde"] + r["count_noite"] + r["count_madrugada"] == r["count"]


def test_pareto_sizes_and_order(report):
    p = report["pareto"]
    u = report["totals"]["unique_texts"]
    assert p.n == math.ceil(u * 0.2) == 77
    for by, share in (("amount", "percentual_amount"), ("count", "percentual_count")):
        sel = p.selection(by).orderBy("rank").collect()
        assert [r["rank"] for r in sel] == list(range(1, p.n + 1))
        keys = [(-r[share], r["text"]) for r in sel]
        assert keys == sorted(keys)
        rest = [(-r[share], r["text"]) for r in report["compat"] if r["text"] not in {s["text"] for s in sel}]
        assert max(keys) < min(rest)
    flags = p.flags().agg(F.count("pareto_amount"), F.count("pareto_count")).collect()[0]
    assert tuple(flags) == (p.n, p.n)


def test_id_chunks_cover_all_rows(report, spark):
    chunks = text_id_chunks(report["lines"], span=64)
    agg = chunks.agg(F.sum("n_ids"), F.max(F.col("last_id") - F.col("first_id"))).collect()[0]
    assert agg[0] == report["totals"]["total_count"]
    assert agg[1] < 64
    joined = {}
    for r in chunks.orderBy("text", "chunk", "part").collect():
        joined.setdefault(r["text"], []).append(r["row_ids"])
    counts = {r["text"]: r["count"] for r in report["compat"]}
    assert {t: len("|".join(v).split("|")) for t, v in joined.items()} == counts
