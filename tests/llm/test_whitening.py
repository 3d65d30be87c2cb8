"""Whitening against exact fractions and numpy on small fixtures."""

from fractions import Fraction

import numpy as np
import pytest

from linetally.llm import whitening


@pytest.mark.parametrize("rows,dims,most", [(1, 3, 5), (64, 2, 1), (65, 5, 300), (200, 7, 2**44), (130, 1, 0)])
def test_scatter_is_exact(rows, dims, most):
    rng = np.random.default_rng(rows)
    x = rng.integers(-most, most + 1, (rows, dims))
    sums, cross = whitening.scatter(x)
    big = x.astype(object)
    assert list(sums) == list(big.sum(axis=0)) and (cross == big.T @ big).all()


def _expected(vectors, components=4):
    """n, S, whitened values and so on, from the definition."""
    x = [tuple(int(np.floor(np.float64(256) * np.float64(c))) for c in v) for v in vectors]
    fit = sorted(set(x))
    n, d = len(fit), len(fit[0])
    s = [sum(v[j] for v in fit) for j in range(d)]
    cov = np.array([[float(sum((Fraction(v[i]) - Fraction(s[i], n)) * (Fraction(v[j]) - Fraction(s[j], n)) for v in fit) / n)
                     for j in range(d)] for i in range(d)])
    e, u = np.linalg.eigh(cov)
    order = np.argsort(-e)[:components]
    w = (np.array(x, float) - np.array(s, float) / n) @ u[:, order] / np.sqrt(e[order])
    return x, n, [sum((n * c - t) ** 2 for c, t in zip(v, s)) for v in x], w, e[order] / np.trace(cov)


def test_whitened_rows_against_the_definition(spark):
    rng = np.random.default_rng(5)
    v = (rng.normal(size=(300, 6)) * [9, 5, 3, 2, 1, 0.5]).astype(np.float32)
    v[100:200] = v[100]  # a third of the rows is one vector
    v[7, 2] = -0.0
    rows = [(i, v[i].tolist(), "c", 1.0) for i in range(300)] + [(None, v[3].tolist(), None, None)]
    odd = [(900, None), (901, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (902, [float("nan")] * 6), (903, [float("inf")] * 6), (904, []), (905, [1.0, 2.0])]
    df = spark.createDataFrame(rows + [(*r, "c", 1.0) for r in odd], "vec_id long, embedding array<float>, label string, whitened double")
    x, n, dev, w, explained = _expected([*v, v[3]])
    for spread in (1, 7):
        got = whitening.whiten(df.repartition(spread)).collect()
        assert len(got) == 4 * 301 and {r["n"] for r in got} == {n} and got[0].asDict().keys() == {"vec_id", "label", *whitening.MADE}
        by = {(r["vec_id"], r["component"]): r for r in got}
        assert [by[i, 1]["deviation"] for i in range(300)] == dev[:300] and by[None, 1]["deviation"] == dev[3]
        for k in range(4):
            own = np.array([by[i, k + 1]["whitened"] for i in range(300)])
            sign = np.sign(own @ w[:300, k])
            assert np.allclose(own * sign, w[:300, k], rtol=1e-9, atol=1e-9)
            assert abs(by[0, k + 1]["explained"] / explained[k] - 1) < 1e-9
        assert max(r["identity_error"] for r in got) < 1e-9
        if spread == 1:
            first = sorted(map(str, got))
    assert sorted(map(str, got)) == first  # the same to the last bit however the rows are spread


def test_flat_components_few_dimensions_and_nothing(spark):
    schema = "vec_id long, embedding array<double>"
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(9)], schema)).collect()
    assert {r["component"] for r in line} == {1, 2, 3} and all((r["whitened"] is None) == (r["component"] > 1) for r in line)
    assert all(r["identity_error"] < 1e-9 for r in line)
    same = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["identity_error"]) for r in same] == [(1, 0, None, None)] * 4
    for rows in ([], [(1, None), (2, [])]):
        assert whitening.whiten(spark.createDataFrame(rows, schema)).count() == 0
