"""Merkle manifest against plain Python: trees, multiproofs, tampering."""

import random
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from linetally.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, claimed int"


def _h(s):
    return sha256(s.encode()).hexdigest()


def _leaf(doc_id, text, lang, source, n_chars):
    values = (doc_id, source, lang, n_chars, text)
    return _h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([_h("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def _proof(levels, i):
    out = []
    for level in levels[:-1]:
        first = i - i % 8
        out.append((i % 8, [h for k, h in enumerate(level[first:first + 8], first) if k != i]))
        i //= 8
    return out


def _expected(rows):
    """A list of (doc_id, leaf, subroot, root, proof, folded_root, verified)."""
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted(((r[0] is not None, r[0] or 0, _leaf(*r)), r) for r in rows if r[2] == lang) if lang is not None else sorted(
            (((r[0] is not None, r[0] or 0, _leaf(*r)), i) for i, r in enumerate(rows) if r[2] is None))
        trees[lang] = [rows[x[1]] if isinstance(x[1], int) else x[1] for x in own]
    levels = {lang: _levels([_leaf(*r) for r in own]) for lang, own in trees.items()}
    top = _levels([levels[lang][-1][0] for lang in langs])
    out = []
    for t, lang in enumerate(langs):
        for i, r in enumerate(trees[lang]):
            steps = _proof(levels[lang], i) + _proof(top, t)
            text = r[1]
            if text is not None and r[0] is not None and crc32(str(r[0]).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            at = _leaf(r[0], text, *r[2:])
            for place, others in steps:
                at = _h("".join([*others[:place], at, *others[place:]]))
            out.append((r[0], _leaf(*r), levels[lang][-1][0], top[-1][0], [h for _, o in steps for h in o], at, at == top[-1][0]))
    return out


def _run(spark, rows, wanted=None, digests=False):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(5)
    manifest = merkle.document_manifest(df, claimed=merkle.tampered_text(F.col("doc_id"), F.col("text")))
    asked = None if wanted is None else manifest.leaves.where(wanted)
    got = merkle.prove(manifest, asked, claimed="claimed", digests=digests).collect()
    assert "claimed" not in (got[0].asDict() if got else {})
    return sorted(((r["doc_id"], r["leaf"], r["subroot"], manifest.root, r["proof_sha256" if digests else "proof"], r["folded_root"], r["verified"])
                   for r in got), key=str)


def _rows(n, seed=1):
    r = random.Random(seed)
    langs = ["en"] * 6 + ["de", "fr", None, "Zü", "é"]
    return [(i, r.choice(["Some Text é🙂", "lower only", "", None, f"T{i}"]), r.choice(langs), r.choice(["a", None]), r.choice([None, i])) for i in range(n)]


@pytest.mark.parametrize("block_levels,askers", [(4, 1024), (1, 1)])
def test_all_proofs(spark, monkeypatch, block_levels, askers):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", block_levels)
    monkeypatch.setattr(merkle, "ASKERS", askers)
    rows = _rows(1500) + [(5, "Same", "en", None, 1)] * 40 + [(None, "No Id", "en", "a", 1)] * 20 + [(7, "x" * 200_000, "solo", "a", 1)]
    want = sorted(_expected(rows), key=str)
    assert _run(spark, rows) == want
    assert any(not w[-1] for w in want) and any(w[-1] for w in want)


@pytest.mark.parametrize("block_levels,askers", [(4, 1024), (2, 1)])
def test_some_leaves_fetch_the_nodes_they_lack(spark, monkeypatch, block_levels, askers):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", block_levels)
    monkeypatch.setattr(merkle, "ASKERS", askers)
    rows = _rows(900, 3)
    want = sorted((w for w in _expected(rows) if w[0] % 37 == 0), key=str)
    assert _run(spark, rows, F.col("doc_id") % 37 == 0) == want
    want = [(*w[:4], _h("".join(w[4])), *w[5:]) for w in want]
    assert _run(spark, rows, F.col("doc_id") % 37 == 0, digests=True) == sorted(want, key=str)


def test_many_trees(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 1)
    rows = [(i, f"T{i}", f"l{i % 90}", "s", i) for i in range(200)]
    assert _run(spark, rows) == sorted(_expected(rows), key=str)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)], [(1, "A", "en", None, 3), (3, "B", "de", "s", None)]])
def test_tiny(spark, rows):
    assert _run(spark, rows) == (sorted(_expected(rows), key=str) if rows else [])


def test_missing_is_minimal():
    """Each coordinate fetched is needed, and what is fetched is enough, on random sets of leaves."""
    r = random.Random(2)
    for n in (1, 2, 8, 9, 64, 65, 700):
        levels = _levels([_h(str(i)) for i in range(n)])
        for _ in range(20):
            own = r.sample(range(n), r.randint(1, min(n, 9)))
            need = merkle.missing(own, n)
            nodes = merkle.derived({i: levels[0][i] for i in own}, {(a, b): levels[a][b] for a, b in need}, n)
            assert nodes[len(levels) - 1, 0] == levels[-1][0]
            assert all(merkle.path(nodes, i, n) == _proof(levels, i) for i in own)
            used = {(a, k) for i in own for a, w in enumerate(merkle.widths(n)[:-1]) for k in merkle.siblings(w, i // 8**a) if k != i // 8**a}
            own_paths = {(a, i // 8**a) for i in own for a in range(len(levels))}
            assert set(need) == used - own_paths and len(need) == len(set(need))
