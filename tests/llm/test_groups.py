"""Near duplicates, mixing and nearest neighbours against brute force."""

import contextlib
import io
import random
import re

import numpy as np
import pytest

from linetally.llm import ann, mixing, neardup


def test_shared_counts_are_exact(monkeypatch):
    monkeypatch.setattr(neardup, "COLUMNS", 7)
    rng = np.random.default_rng(3)
    left, right = ([np.unique(rng.integers(0, 90, rng.integers(1, 60)).astype(np.uint64)) for _ in range(k)] for k in (9, 5))
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in right] for a in left]
    assert neardup.shared_counts(left, right).tolist() == want
    assert neardup.shared_counts([np.array([1], np.uint64)], [np.array([2], np.uint64)]).tolist() == [[0]]


@pytest.mark.parametrize("block", [1024, 30])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    r = random.Random(5)
    base = [f"w{r.randrange(5000)}" for _ in range(100)]
    rows = []
    for i in range(120):  # one group of near copies, of which many pairs are no links
        w = list(base)
        for _ in range(r.randrange(0, 4)):
            w[r.randrange(100)] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    rows += [(i, " ".join(f"y{r.randrange(3000)}" for _ in range(60))) for i in range(120, 150)]
    rows += [(200, None), (201, ""), (202, "a b"), (203, "A  b"), (None, rows[0][1])]
    method = neardup.Method(3, 85)
    df = spark.createDataFrame([(*x, "c") for x in rows], "doc_id long, text string, component_id string")
    got = {x.doc_id: x for x in neardup.near_duplicates(df, method).collect()}
    sets = {i: set(neardup.shingles((t or "").encode(), 3).tolist()) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    for i in sets:
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(sets[i]), find(i), find(i) == i)
    assert got[None].kept and got[None].component_id is None


def test_near_duplicates_of_nothing(spark):
    assert neardup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_mix_meets_targets(spark):
    r = random.Random(1)
    rows = [(i, "w " * r.randrange(0, 40), r.choice(["b", "a", None, "c"]), 7) for i in range(2000)]
    rows += [(5000, None, "a", 7), (5000, None, "a", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size long")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    total = sum(x["size"] for x in got)
    by = {}
    for x in got:
        assert x["taken"] in (0, x["size"], 2 * x["size"])
        t = by.setdefault(x["source"], [0, 0, x["target"]])
        t[0] += x["taken"]
        t[1] += x["size"]
    assert abs(sum(t[2] for t in by.values()) - 1.5 * total) < 1e-6
    for taken, size, target in by.values():
        assert target <= 2 * size and abs(taken - target) <= 80
    assert sum(t[0] for t in by.values()) <= 1.5 * total
    again = {(x["doc_id"], x["taken"]) for x in mixing.mix(df.repartition(7)).collect()}
    assert again == {(x["doc_id"], x["taken"]) for x in got}
    assert mixing.mix(df.limit(0)).count() == 0


def test_mix_writes_texts_once_and_shuffles_none(spark, monkeypatch):
    def exchanged(df):
        with contextlib.redirect_stdout(io.StringIO()) as plan:
            df.explain("formatted")
        return re.findall(r"\(\d+\) Exchange\n(?:Input|Output) .*", plan.getvalue())

    written, shuffles = [], []

    def recorded(df, label):
        written.extend([label] * ("text" in df.columns))
        shuffles.extend(exchanged(df))
        return materialize(df, label)

    materialize = mixing.materialize
    monkeypatch.setattr(mixing, "materialize", recorded)
    rows = [(i % 300, f"w{i} " * (i % 7), "abc"[i % 3]) for i in range(400)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    shuffles += exchanged(got)
    assert sorted(x.text for x in got.collect()) == sorted(t for _, t, _ in rows)
    assert written == ["mix-sized"] and len(shuffles) > 3
    assert not [x for x in shuffles if "text#" in x]


def test_mix_cuts_among_rows_of_one_id(spark):
    rows = [(1, f"w{i} w", "a") for i in range(31)] + [(None, f"v{i}", None) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).collect()
    assert sorted(x.text for x in got) == sorted(t for _, t, _ in rows)
    # 123 of 82 words: a (weight 5) is full at 124 before the other has 40, so its target is the level's
    level = 123 / 7
    assert {x.source: x.target for x in got} == {"a": pytest.approx(5 * level), None: pytest.approx(2 * level)}
    for source, size, weight in (("a", 2, 5), (None, 1, 2)):
        times = sorted(x.taken // size for x in got if x.source == source)
        assert times[-1] - times[0] == 1  # every row once before one is taken again
        assert abs(sum(times) * size - weight * level) <= 2


def test_nearest_is_exact_with_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 8))
    x[300:600] = x[300]  # a third of all rows are one vector
    rows = [(i, x[i].tolist()) for i in range(900)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 8), (2003, [float("nan")] * 8), (2004, [1.0, None, *[2.0] * 6]), (None, x[0].tolist()),
             (2005, [1.0, 2.0])]
    df = spark.createDataFrame([(*v, 1) for v in rows], "vec_id long, embedding array<double>, score int")
    asked = df.where("vec_id % 50 = 0")
    got = {}
    for r in ann.nearest(df, asked, k=10).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {i for i in range(0, 900, 50)}
    for q, found in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        order = sorted((i for i in range(900) if i != q), key=lambda i: (d[i], i))[:10]
        assert [v for _, v, _ in sorted(found)] == order
    loose = ann.nearest(df, asked, k=10, factor=0.5).count()
    assert 0 < loose <= 180
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0


@pytest.mark.parametrize(("shingle", "percent"), [(3, 85), (5, 80)])
def test_links_share_a_band_and_agree(shingle, percent):
    """Pairs at the threshold, or the least similarity above it that their size allows."""
    method, rng = neardup.Method(shingle, percent), np.random.default_rng(11)
    donors = neardup.donor_orders(method.bins)
    for union in np.r_[np.arange(5, 105), rng.integers(105, 1000, 300)]:
        x = rng.integers(0, 1 << 63, union, np.uint64)
        alone = union - -(-union * percent // 100)
        cut = rng.integers(0, alone + 1)
        a, b = np.unique(x[cut:]), np.unique(np.r_[x[:cut], x[alone:]])
        assert 100 * len(np.intersect1d(a, b)) >= percent * len(np.union1d(a, b))
        sa, sb = (neardup.signature(s, method.bins, donors) for s in (a, b))
        assert (neardup.band_keys(sa, method.rows) == neardup.band_keys(sb, method.rows)).any()
        assert (sa.astype("<u2") == sb.astype("<u2")).sum() >= method.least_agreement


def test_nearest_with_smaller_factors_recalls_most():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(8000, 16))
    asked = np.arange(0, 8000, 100)
    tree = ann.Tree(np.arange(8000), x)
    exact, _ = tree.search(asked, x[asked], 10, 1.0)
    d = np.sqrt(((x[None, :, :] - x[asked[:5], None, :]) ** 2).sum(axis=2))
    d[np.arange(5), asked[:5]] = np.inf
    assert (exact[:5] == np.argsort(d, axis=1, kind="stable")[:, :10]).all()
    for factor in (0.7, 0.5):
        found, _ = tree.search(asked, x[asked], 10, factor)
        recall = np.mean([len(set(a) & set(b)) / 10 for a, b in zip(found.tolist(), exact.tolist())])
        print("recall", factor, recall)
        assert recall >= 0.9
