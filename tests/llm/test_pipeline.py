"""Stages of the corpus pipeline, and all of it, on planted rows against plain Python."""

import hashlib
import random

import pytest
from test_toxicity_pii import _brute
from tokenizers import Tokenizer

import corpus_pipeline
from linetally.llm import neardup, queries, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, kept int, size string, ids_sha256 string"
COLUMNS = [f.split()[0] for f in SCHEMA.split(", ")]


def test_a_text_under_a_repeated_id_is_not_lost(spark):
    copy = " ".join(f"w{i}" for i in range(40))
    alone = " ".join(f"v{i}" for i in range(40))
    rows = [(1, copy), (5, copy), (5, alone), (6, copy), (7, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in corpus_pipeline.near_dedup_stage(spark, docs, "").collect()]
    assert (5, alone) in kept and (1, copy) in kept and (6, copy) not in kept
    assert (7, None) in kept and (8, "") in kept


def _corpus(seed=8, n=320):
    """Rows and labels: toxic ones, copies, near copies, personal data, null, empty, repeated and long ones."""
    r = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    plain = ["".join(r.choice(letters) for _ in range(r.randrange(2, 8))) for _ in range(700)]
    texts, toxic = [], []
    for i in range(n):
        w = [r.choice(plain) for _ in range(r.randrange(12, 60))]
        bad = i % 6 == 1
        for _ in range(5 if bad else 0):
            w[r.randrange(len(w))] = r.choice(["gruddle", "snarkel", "blorfing"])
        if i % 9 == 2:
            w[r.randrange(1, len(w) - 1)] = r.choice(["ann@x.org", "10.1.2.3", "4111111111111111", f"mail{i}@y.net"])
        texts.append(" ".join(w))
        toxic.append(int(bad))
    for i in (0, 3, 4):  # exact copies and near copies of clean rows, under greater ids
        texts += [texts[i], texts[i].upper(), texts[i] + " more"]
        toxic += [0, 0, 0]
    texts += [None, "", " ".join(r.choice(plain) for _ in range(9000))]
    toxic += [0, 0, 0]
    rows = [(i, t, r.choice(["en", "de", None]), r.choice(["a", "b", None]), len(t or ""), "s", i, "z", "h") for i, t in enumerate(texts)]
    rows += [rows[5], (*rows[5][:2], "xx", *rows[5][3:]), (None, "a row without id of some words only", "en", "a", 1, "s", 1, "z", "h")]
    return rows, [(i, y) for i, y in enumerate(toxic)] + [(None, 1), (10_000, 1)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, labels = _corpus()
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def _sorted(rows):
    return sorted(map(tuple, rows), key=str)


def _unique_by_shingles(rows):
    """One row of each group of near copies: the least id of each component of links, brute force."""
    sets = [set(neardup.shingles((x[1] or "").encode(), 5).tolist()) for x in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and rows[a][0] is not None and rows[b][0] is not None and 100 * both >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for i, x in enumerate(rows):
        if x[0] is not None:
            least[find(i)] = min(least.get(find(i), x[0]), x[0])
    kept = [x for i, x in enumerate(rows) if x[0] is None or not sets[i] or x[0] == least[find(i)]]
    once = {}
    for x in sorted(kept, key=lambda x: [(v is not None, v if v is not None else 0) for v in x]):  # nulls first
        once.setdefault((x[0], x[1]) if x[0] is not None else object(), x)
    return list(once.values())


def _sanitised(rows):
    spans, told = _brute([(i, x[1]) for i, x in enumerate(rows)])
    out = []
    for i, x in enumerate(rows):
        text = x[1]
        for kind, a, b in sorted((s.split(":") for s in spans[i].split(",") if s), key=lambda s: -int(s[1])):
            a, b = int(a), int(b)
            marker = f"[{kind.upper()}]"
            if kind == "term":
                most = max(d for (_, w), d in told.items() if w == text[a:b])
                marker = "[REMOVED]" if most >= 0.5 else "[WORD]"
            text = text[:a] + marker + text[b:]
        out.append((x[0], text, *x[2:4], None if text is None else len(text), *x[5:]))
    return out


def _mixed(rows):
    """Weighted fair queueing, step by step: each row as often as the mix takes it."""
    size = [len((x[1] or "").split()) for x in rows]
    sources = sorted({x[3] for x in rows}, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    items = []
    for rank, s in enumerate(sources):
        own = [i for i, x in enumerate(rows) if x[3] == s]
        own.sort(key=lambda i: (hashlib.md5(f"mix:{'' if rows[i][0] is None else rows[i][0]}".encode()).hexdigest(), str(rows[i][0] or ""), size[i]))
        sent = 0
        for i in own * 2:
            sent += size[i]
            if size[i]:
                items.append((sent / weight[s], rank, sent, i))
    budget, used, out = sum(size) * 3 // 2, 0, []
    for *_, i in sorted(items):
        used += size[i]
        if used > budget:
            break
        out.append(rows[i])
    return out


def _encoded(rows):
    lib = Tokenizer.from_file(queries.bpe_path())
    out = []
    for x in rows:
        ids = lib.encode(x[1] or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((x[0], x[2], x[3], len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids, skip_special_tokens=False))))
    return out


def test_each_stage_equals_brute_force(spark, folder):
    rows, labels = _corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    kept = corpus_pipeline.toxicity_stage(spark, docs, folder)
    scored = toxicity.classify(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert kept.columns == COLUMNS and "rejected" not in kept.columns
    verdict = {r["doc_id"]: r["rejected"] for r in scored.select("doc_id", "rejected").collect()}
    assert _sorted(kept.collect()) == _sorted(x for x in rows if not verdict[x[0]])
    gone = {x[0] for x in rows if verdict[x[0]]}
    assert gone <= {i for i, y in labels if y} and len(gone) > 0.9 * sum(y for i, y in labels if i is not None and i < 10_000)
    for stage, plain in ((corpus_pipeline.near_dedup_stage, _unique_by_shingles), (corpus_pipeline.pii_stage, _sanitised), (corpus_pipeline.mix_stage, _mixed)):
        got = stage(spark, docs, folder)
        assert got.columns == COLUMNS
        want = plain(rows)
        assert _sorted(got.collect()) == _sorted(want), stage.__name__
        assert stage(spark, docs.limit(0), folder).count() == 0
    assert _sorted(corpus_pipeline.encode_stage(spark, docs, folder).collect()) == _sorted(_encoded(rows))


def test_the_whole_pipeline_equals_brute_force(spark, folder):
    rows, labels = _corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    scored = toxicity.classify(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    verdict = {r["doc_id"]: r["rejected"] for r in scored.select("doc_id", "rejected").collect()}
    want = [x for x in rows if not verdict[x[0]]]
    for step in (_unique_by_shingles, _sanitised, _mixed, _encoded):
        want = step(want)
    assert _sorted(corpus_pipeline.run(spark, folder).collect()) == _sorted(want)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "pii", "mix", "encode"]
