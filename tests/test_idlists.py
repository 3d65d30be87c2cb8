import random

from pyspark.sql import functions as F

from linetally.operators import idlists
from linetally.operators.idlists import id_chunks, ranked_id_chunks


def _brute(rows, span):
    ranges = {}
    for k, i in rows:
        ranges.setdefault((k, i // span), []).append(i)
    out = {}
    for (k, c), ids in ranges.items():
        ids.sort()
        for pos in range(0, len(ids), span):
            out[(k, c, pos // span)] = "|".join(str(x) for x in ids[pos:pos + span])
    return out


def test_chunks_match_brute_force(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice("abc"), rnd.randint(-50, 200)) for _ in range(2000)]
    rows += [("hot", i) for i in range(500)]  # one dominant key
    df = spark.createDataFrame(rows, "k string, id long").repartition(8)
    got = {(r["k"], r["chunk"], r["part"]): r["row_ids"] for r in id_chunks(df, ["k"], "id", span=16).collect()}
    assert got == _brute(rows, 16)


def test_concatenated_chunks_give_whole_list(spark):
    rows = [("x", i) for i in (5, 1, 99, 3, 42, 42, 7)]
    df = spark.createDataFrame(rows, "k string, id long")
    chunks = sorted(id_chunks(df, ["k"], "id", span=4).collect(), key=lambda r: (r["chunk"], r["part"]))
    assert "|".join(r["row_ids"] for r in chunks) == "1|3|5|7|42|42|99"
    assert sum(r["n_ids"] for r in chunks) == len(rows)
    assert all(r["last_id"] - r["first_id"] < 4 for r in chunks)


def test_distinct_lists(spark):
    df = spark.createDataFrame([("x", 1), ("x", 1), ("x", 2)], "k string, id long")
    r = id_chunks(df, ["k"], "id", span=100, out_col="clients", distinct=True).collect()
    assert [x["clients"] for x in r] == ["1|2"]


def test_repeated_id_is_split_into_bounded_cells(spark):
    # one id in a third of the rows of one key: cells stay within `span`
    rows = [("hot", 7)] * 1000 + [("hot", i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, id long").repartition(8)
    cells = id_chunks(df, ["k"], "id", span=50).orderBy("chunk", "part").collect()
    assert max(r["n_ids"] for r in cells) <= 50
    assert sum(r["n_ids"] for r in cells) == len(rows)
    whole = "|".join(r["row_ids"] for r in cells).split("|")
    assert whole == [str(x) for x in sorted(i for _, i in rows)]
    assert {(r["chunk"], r["part"]): r["row_ids"] for r in cells} == {
        (c, p): v for (_, c, p), v in _brute(rows, 50).items()
    }


def test_one_id_in_a_third_of_the_rows_is_spread_over_tasks(spark, monkeypatch):
    """Cells that it fills alone are made in many tasks, and no array is longer than the fan or the span."""
    span, n = 256, 300_000
    df = spark.range(n).select(F.lit("hot").alias("k"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("id"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        cells = id_chunks(df, ["k"], "id", span=span)
        same = cells.where("first_id = 7 AND last_id = 7").select(F.spark_partition_id().alias("p"), "n_ids")
        tasks = same.groupBy("p").count().collect()
        whole = cells.agg(F.sum("n_ids"), F.max("n_ids"), F.sum(F.size(F.split("row_ids", "[|]")))).first()
        assert len(tasks) >= 8 and sum(r["count"] for r in tasks) >= n // 3 // span - 1
        assert tuple(whole) == (n, span, n)
        monkeypatch.setattr(idlists, "FAN", 3)
        again = id_chunks(df, ["k"], "id", span=span)
        assert again.exceptAll(cells).isEmpty() and cells.exceptAll(again).isEmpty()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_repeats_at_all_offsets_match_brute_force(spark):
    rnd = random.Random(5)
    rows = [("a", i) for i in range(40) for _ in range(rnd.choice([1, 1, 2, 7, 8, 9, 30]))] + [("b", -3)] * 64 + [("c", 5)] * 65
    df = spark.createDataFrame(rows, "k string, id long").repartition(4)
    for span in (1, 8):
        got = {(r["k"], r["chunk"], r["part"]): (r["row_ids"], r["n_ids"]) for r in id_chunks(df, ["k"], "id", span=span).collect()}
        assert got == {k: (v, len(v.split("|"))) for k, v in _brute(rows, span).items()}


def test_ids_of_any_type_are_cut_by_position(spark):
    rnd = random.Random(6)
    rows = [(rnd.choice(["x", "y", None]), f"u{rnd.randrange(300)}") for _ in range(3000)] + [("hot", f"é{i}") for i in range(500)] + [("x", None)]
    df = spark.createDataFrame(rows, "k string, u string").repartition(7)
    groups = {}
    for k, u in set(rows):
        if u is not None:
            groups.setdefault(k, []).append(u)
    want = {}
    for k, ids in groups.items():
        ids.sort(key=str.encode)
        for at in range(0, len(ids), 16):
            part = ids[at:at + 16]
            want[k, at // 16] = (0, part[0], part[-1], len(part), "|".join(part))
    got = {(r["k"], r["chunk"]): (r["part"], r["first_id"], r["last_id"], r["n_ids"], r["clients"]) for r in ranked_id_chunks(df, ["k"], "u", span=16).collect()}
    assert got == want and ranked_id_chunks(df.limit(0), ["k"], "u").count() == 0
