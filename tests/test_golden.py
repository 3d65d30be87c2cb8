import pytest
from pyspark.sql import functions as F

from golden import lines
from linetally.operators import profile as prof
from linetally.operators.clients import client_report
from linetally.operators.idlists import text_id_chunks
from linetally.operators.pareto import pareto
from linetally.schema import LineColumns

approx = pytest.approx


def test_totals(spark):
    t = prof.text_totals(lines(spark)).collect()[0].asDict()
    assert t == {
        "total_count": 5, "total_amount": 45.0, "undefined_count": 2, "undefined_amount": 25.0,
        "categorised_count": 3, "categorised_amount": 20.0, "unique_texts": 3,
    }


@pytest.mark.parametrize("materialize", [True, False])
def test_profile_compat(spark, materialize):
    rows = {r["text"]: r.asDict() for r in prof.text_profile(lines(spark), compat=True, materialize=materialize).collect()}
    assert set(rows) == {"pagto cartão", "posto_x"}
    a, b = rows["pagto cartão"], rows["posto_x"]
    assert (a["count"], a["amount"], a["category"], a["category_percentual_quartil"]) == (2, 30.0, "ALIM", 1)
    assert (b["count"], b["amount"], b["category"], b["category_percentual_quartil"]) == (2, 10.0, "TRANSP", 4)
    assert a["percentual_count"] == approx(0.4) and b["percentual_count"] == approx(0.4)
    assert a["percentual_amount"] == approx(30 / 45) and b["percentual_amount"] == approx(10 / 45)
    assert (a["count_dia"], a["count_tarde"], a["count_noite"], a["count_madrugada"]) == (0, 1, 1, 1)
    assert (b["count_dia"], b["count_tarde"], b["count_noite"], b["count_madrugada"]) == (1, 1, 1, 0)
    assert (a["percentual_dia"], a["percentual_tarde"], a["percentual_noite"], a["percentual_madrugada"]) == (0.0, 0.5, 0.5, 0.0)
    assert (b["percentual_dia"], b["percentual_tarde"], b["percentual_noite"], b["percentual_madrugada"]) == (0.5, 0.5, 0.5, 0.5)
    # shares of the totals: the empty text is counted in the totals but not shown
    assert sum(r["percentual_count"] for r in rows.values()) == approx(0.8)


def test_profile_fixed(spark):
    rows = {r["text"]: r.asDict() for r in prof.text_profile(lines(spark), compat=False).collect()}
    a, b = rows["pagto cartão"], rows["posto_x"]
    assert a["count_noite"] == 0 and b["count_noite"] == 0
    assert (a["percentual_noite"], a["percentual_madrugada"]) == (0.0, 0.5)
    assert (b["percentual_noite"], b["percentual_madrugada"]) == (0.0, 0.0)
    for r in rows.values():  # fixed day parts partition the rows
        assert r["count_dia"] + r["count_tarde"] + r["count_noite"] + r["count_madrugada"] == r["count"]


def test_row_ids(spark):
    rows = {r["text"]: r["row_ids"] for r in text_id_chunks(lines(spark)).collect()}
    assert rows == {"pagto cartão": "1|2", "posto_x": "4|8"}


def test_pareto(spark):
    p = pareto(prof.grouped(lines(spark)), 0.2)
    assert p.n == 1 and p.unique_texts == 3
    assert [r["text"] for r in p.selection("amount").collect()] == ["pagto cartão"]
    assert [r["text"] for r in p.selection("count").collect()] == ["pagto cartão"]
    flags = {r["text"]: (r["pareto_amount"], r["pareto_count"]) for r in p.flags().collect()}
    assert flags == {"pagto cartão": (1, 1), "posto_x": (None, None)}
    summary = {r["ranking"]: r.asDict() for r in p.summary().collect()}
    for by in ("amount", "count"):
        assert summary[by]["amount"] == 30.0
        assert summary[by]["categorised_groups"] == 1
        assert summary[by]["undefined_groups"] == 0


def test_empty_input(spark):
    empty = lines(spark).limit(0)
    assert prof.text_profile(empty).count() == 0
    t = prof.text_totals(empty).collect()[0]
    assert (t["total_count"], t["total_amount"], t["unique_texts"]) == (0, 0.0, 0)


def test_zero_total_amount_gives_null_share(spark):
    df = spark.createDataFrame(
        [(1, "a", 5.0, "X", 10.0, None, 1, "I"), (2, "b", -5.0, "X", 10.0, None, 1, "I")],
        lines(spark).schema,
    )
    rows = prof.text_profile(df, strict=False).collect()
    assert all(r["percentual_amount"] is None for r in rows)
    assert sorted(r["percentual_count"] for r in rows) == [0.5, 0.5]


def test_all_texts_empty(spark):
    df = spark.createDataFrame([(1, "123", 5.0, "X", 10.0, None, 1, "I")], lines(spark).schema)
    assert prof.text_profile(df, strict=False).count() == 0
    assert prof.text_totals(df, strict=False).collect()[0]["unique_texts"] == 1


def test_nan_amount_is_not_dropped_by_gate(spark):
    df = spark.createDataFrame([(1, "a", float("nan"), "X", 10.0, None, 1, "I")], lines(spark).schema)
    assert prof.gate(df).count() == 1


def test_round_to_two_places(spark):
    rows = {r["text"]: r for r in prof.text_profile(lines(spark), round_to=2).collect()}
    assert rows["pagto cartão"]["percentual_amount"] == 0.67
    assert rows["posto_x"]["percentual_amount"] == 0.22


def test_client_profile(spark):
    from linetally.operators.clients import client_report

    prof_df, lists = client_report(lines(spark), span=100)
    got = {(r["text"], r["institution"]): (r["count"], r["value"], r["category"], r["count_clients"]) for r in prof_df.collect()}
    assert got == {
        ("pagto cartão", "BANK_A"): (2, 30.0, "ALIM", 2),
        ("posto_x", "BANK_B"): (2, 10.0, "TRANSP", 2),
    }
    got = {(r["text"], r["institution"]): r["clients"] for r in lists.collect()}
    assert got == {("pagto cartão", "BANK_A"): "100|101", ("posto_x", "BANK_B"): "100|102"}


@pytest.mark.parametrize("bad", [float("nan"), float("inf")])
def test_non_finite_amount_fails_under_ansi(spark, bad):
    df = spark.createDataFrame([(1, "a", bad, "X", 10.0, None, 1, "I")], lines(spark).schema)
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    with pytest.raises(Exception):
        prof.text_profile(df, materialize=False).collect()


def test_malformed_percentage_strict_and_lenient(spark):
    from pyspark.sql import functions as F

    df = lines(spark).where(F.col("row_id") == 4).withColumn("category_pct", F.lit("n/a"))
    with pytest.raises(Exception):
        prof.text_profile(df, strict=True, materialize=False).collect()
    r = prof.text_profile(df, strict=False, materialize=False).collect()[0]
    assert r["category_percentual_quartil"] == 0


def test_pareto_on_empty_input(spark):
    p = pareto(prof.grouped(lines(spark).limit(0)))
    assert (p.n, p.unique_texts) == (0, 0)
    assert p.flags().count() == 0 and p.selection("amount").count() == 0
    assert sorted(tuple(r) for r in p.summary().collect()) == [("amount", 0.0, 0, 0), ("count", 0.0, 0, 0)]


def test_null_percentage_or_timestamp_fails_in_strict_mode(spark):
    row = lines(spark).where("row_id = 1")
    for column in ("category_pct", "ts"):
        df = row.withColumn(column, F.lit(None).cast(row.schema[column].dataType))
        with pytest.raises(Exception, match="null"):
            prof.text_profile(df, materialize=False).collect()
        r = prof.text_profile(df, strict=False, materialize=False).collect()[0]
        assert r["count"] == 1
    assert r["count_dia"] + r["count_tarde"] + r["count_noite"] + r["count_madrugada"] == 0


def test_amounts_are_never_rounded(spark):
    one = lines(spark).where("row_id = 1")
    small = one.withColumn("amount", F.lit(0.004)).withColumn("row_id", F.explode(F.sequence(F.lit(1), F.lit(1000))))
    assert abs(prof.text_totals(small).collect()[0]["total_amount"] - 4.0) < 1e-9
    large = one.withColumn("amount", F.lit(2e16))
    assert prof.text_totals(large).collect()[0]["total_amount"] == 2e16

    class Cents(LineColumns):
        amount_type = "decimal(18,2)"

    with pytest.raises(Exception, match="does not fit"):
        prof.text_totals(small, Cents()).collect()


def test_null_institution_is_a_client_group(spark):
    df = lines(spark).where("row_id in (1, 2, 4)").withColumn(
        "institution", F.when(F.col("row_id") == 4, F.lit("B"))).withColumn("user_id", F.concat(F.lit("u"), "user_id"))
    got = {(r["text"], r["institution"]): (r["count"], r["count_clients"]) for r in client_report(df)[0].collect()}
    assert got == {("pagto cartão", None): (2, 2), ("posto_x", "B"): (1, 1)}


def _measures(df):
    return sorted(tuple(r) for r in prof.text_groups(df).collect())


def test_repeated_ids_have_one_representative_whatever_the_order(spark):
    """Least id, then least category, then least bucket, among 300 lines of three ids."""
    base = lines(spark).where("row_id = 1")
    rows = base.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(299)))).withColumns({
        "row_id": F.col("n") % 3, "category": F.when(F.col("n") % 2 == 0, "B").otherwise("A"), "category_pct": (F.col("n") * 37 % 100 + 1).cast("double")}).drop("n")
    least = min((r["row_id"], r["category"], -(-int(r["category_pct"]) // 25)) for r in rows.collect())
    for partitions in (1, 3, 8):
        got = prof.text_groups(rows.repartition(partitions)).select("first_id", "category", "quartil").collect()
        assert [tuple(r) for r in got] == [least]
    from linetally.streaming.profile_stream import streaming_text_groups
    assert _measures(rows) == sorted(tuple(r) for r in streaming_text_groups(rows).collect())


def test_amounts_do_not_depend_on_partitions(spark):
    """Big amounts that cancel, and small ones: the same bits on 1, 3 and 8 partitions, correctly rounded."""
    import math

    amounts = [1e16, 0.1, -1e16, 0.7, 3.3, -0.1] * 50
    schema = lines(spark).schema
    first = lines(spark).first()
    rows = [(i, first["text"] if i % 2 else "other", a, "INDEFINIDO" if i % 3 else "X", 10.0, first["ts"], i % 5, "I") for i, a in enumerate(amounts)]
    want = {t: math.fsum(r[2] for r in rows if (r[0] % 2 == 1) == (t != "other")) for t in ("pagto cartão", "other")}
    total = math.fsum(amounts)
    undefined = math.fsum(r[2] for r in rows if r[3] == "INDEFINIDO")
    for partitions in (1, 3, 8):
        df = spark.createDataFrame(rows, schema).repartition(partitions)
        assert {r["text"]: r["amount"] for r in prof.text_profile(df).collect()} == want
        assert {r["text"]: r["amount"] for r in prof.text_counts(df).collect()} == want
        t = prof.text_totals(df).first()
        assert (t["total_amount"], t["undefined_amount"]) == (total, undefined)
        assert t["categorised_amount"] == math.fsum([*(r[2] for r in rows if r[3] == "X")])
        assert {r["text"]: r["value"] for r in client_report(df)[0].collect()} == want
