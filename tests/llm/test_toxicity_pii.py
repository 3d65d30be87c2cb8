"""The classifier on held-out rows, PII spans against the plain patterns."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from linetally.llm import pii, toxicity


def _docs(n, seed):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        bad = r.random() < 0.2
        w = [f"w{r.randrange(800)}" for _ in range(r.randrange(5, 120))]
        for _ in range(3 if bad else 0):
            w[r.randrange(len(w))] = r.choice(["gruddle", "snarkel", "blorfing"]) + r.choice(["", "s", "ed"])
        rows.append((i, " ".join(w), r.choice(["en", "de"]), int(bad)))
    return rows


def test_classifier_on_held_out_rows(spark):
    rows = _docs(1500, 4)
    docs = spark.createDataFrame([x[:3] for x in rows] + [(9000, None, None), (9001, "", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(x[0], x[3]) for x in rows], "doc_id long, toxic int")
    model = toxicity.fit_on_labels(docs, labels)
    got = {r["doc_id"]: r for r in toxicity.score_texts(docs, model).withColumn("held", toxicity.held_out(F.col("doc_id"))).collect()}
    held = [(got[i]["score"] >= 0.7, y) for i, _, _, y in rows if got[i]["held"]]
    hits = sum(p and y for p, y in held)
    assert hits / sum(y for _, y in held) > 0.9 and hits / sum(p for p, _ in held) > 0.9
    assert all(0 <= r["score"] <= 1 for r in got.values()) and not got[9001]["rejected"] and not got[9000]["rejected"]
    assert toxicity.score_texts(docs.limit(0), model).count() == 0
    assert toxicity.fit_on_labels(docs, labels.limit(0)) is None
    assert {r["score"] for r in toxicity.score_texts(docs, None).collect()} == {0.0}


def test_thresholds_come_from_all_rows_not_trained_on(spark, monkeypatch):
    """Longer texts and those beyond the sample's bounds count, and a language with few toxic rows has a threshold."""
    monkeypatch.setattr(toxicity, "SAMPLE_TOXIC", 60)
    monkeypatch.setattr(toxicity, "SAMPLE_CLEAN", 100)
    rows = [(i, t + (" w1" * 12_000 if i % 50 == 0 else ""), "fr" if i % 12 == 0 else lang, y) for i, t, lang, y in _docs(1500, 4)]
    docs = spark.createDataFrame([x[:3] for x in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(x[0], x[3]) for x in rows], "doc_id long, toxic int")
    seen, given = [], toxicity.calibrate
    monkeypatch.setattr(toxicity, "calibrate", lambda model, cells, n: seen.append((cells, n)) or given(model, cells, n))
    model = toxicity.fit_on_labels(docs, labels)
    usable = [r["doc_id"] for r in docs.where(~toxicity.held_out(F.col("doc_id"))).collect()]
    (cells, toxic), = seen
    # the weights stand for all usable rows, and only rows trained on (at most 60 toxic ones) are not scored
    assert abs(sum(c[3] for c in cells) - len(usable)) < 1e-6
    assert sum(rows[i][3] for i in usable) - 60 <= toxic < sum(rows[i][3] for i in usable)
    assert set(model.thresholds) == {"en", "de", "fr"} and all(0.3 <= t <= 0.95 for t in model.thresholds.values())
    counts = toxicity.label_counts(toxicity.logits(docs, model), labels).groupBy("longer").sum("n").collect()
    assert dict(map(tuple, counts)) == {True: 30, False: 1470}


def test_classify_gives_what_its_model_gives_with_clashing_columns_and_repeated_rows(spark):
    rows = _docs(900, 6)
    rows += [(i, t, "EN-gb" if i % 2 else "???", y) for i, t, _, y in rows[:40]]
    docs = spark.createDataFrame([(*x[:3], 5.0, "t", 7) for x in rows], "doc_id long, text string, lang string, score double, threshold string, n int")
    labels = spark.createDataFrame([(x[0], x[3]) for x in rows], "doc_id long, toxic int")
    got = toxicity.classify(docs, labels)
    assert got.columns == ["doc_id", "text", "lang", "n", "score", "threshold", "rejected"]
    again = toxicity.score_texts(docs, toxicity.fit_on_labels(docs, labels))
    assert sorted(map(str, got.collect())) == sorted(map(str, again.collect())) and got.count() == len(rows)
    cuts = {r["lang"]: r["threshold"] for r in got.collect()}
    assert cuts["EN-gb"] == cuts["en"] and cuts["???"] == toxicity.THRESHOLD
    assert toxicity.classify(docs, labels.limit(0)).where("rejected").count() == 0
    assert toxicity.classify(docs.limit(0), labels).count() == 0


def test_no_text_is_shuffled_to_count_labels(spark):
    rows = _docs(300, 8)
    docs = spark.createDataFrame([x[:3] for x in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(x[0], x[3]) for x in rows], "doc_id long, toxic int")
    scored = toxicity.logits(docs, toxicity.train([b"a", b"b"], np.array([0, 1]), epochs=1), columns=[])
    plan = toxicity.label_counts(scored, labels)._jdf.queryExecution().optimizedPlan().toString()
    joined = next(x for x in plan.split("\n") if "Join" in x)
    assert "text" not in joined and scored.columns == ["_id", "_lang", "_longer", "_logit"]


def test_long_texts_are_scored_few_at_a_time():
    sizes = [10, None, 2 << 20, 5, 1 << 20, 1, 1] + [1000] * 2000
    ranges = list(toxicity.steps(sizes))
    assert [i for a, b in ranges for i in range(a, b)] == list(range(len(sizes)))
    assert all(b - a <= toxicity.STEP and (b - a == 1 or sum(x or 0 for x in sizes[a:b]) <= toxicity.STEP_BYTES) for a, b in ranges)
    assert list(toxicity.steps([])) == []


def test_small_languages_are_drawn_to_the_common_threshold():
    def cut(n):
        model = toxicity.Model(None, [], None, None)
        cells = [("en", 1, 100, 500), ("en", 0, 0, 5000), ("de", 1, -50, n), ("de", 0, -150, 10 * n)]
        toxicity.calibrate(model, cells, 500 + n)
        return model.thresholds["de"], model.thresholds["en"]

    assert abs(cut(1)[0] - cut(1)[1]) < 1e-6 and cut(400)[0] < 0.7


def test_whole_texts_count():
    scorer = toxicity.Scorer(toxicity.Model(
        np.eye(toxicity.BUCKETS, toxicity.DIM, dtype=np.float32), [np.ones((w, toxicity.DIM, toxicity.FILTERS), np.float32) for w in toxicity.WIDTHS],
        np.zeros(24, np.float32), np.ones(25, np.float32)))
    words = [w for w in (f"q{i}" for i in range(200_000)) if min(toxicity.features(w.encode())) < toxicity.DIM][:1]
    plain = "zzz " * 20_000
    a, b = scorer.logits([plain.encode(), (plain + words[0]).encode()])
    assert b > a


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def test_base_spans_equal_the_patterns():
    r = random.Random(9)
    for _ in range(20_000):
        text = "".join(r.choice("ab1.@-_+ 2 25") for _ in range(r.randrange(1, 30)))
        want = [("email", *m.span()) for m in EMAIL.finditer(text)]
        want += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
        assert [s for s in pii.base_spans(text) if s[0] in ("email", "ip")] == want, text
    assert pii.base_spans("c 4111 1111 1111 1111, +1 (555) 010-9999; 4111 1111 1111 1112") == [("card", 2, 21), ("phone", 23, 40)]
    assert pii.base_spans("9" * 100_000 + "a" * 100_000) == []


def test_disclosing_terms_are_found_and_removed(spark):
    rows = [(i, f"plain words here {i} mail zed@x.org of codename bluebird today and more") for i in range(6)]
    rows += [(i, f"plain words here {i} of today and more and mail without anything else") for i in range(6, 60)]
    rows += [(100, None), (101, ""), (102, "only 10.0.0.1 once"), (0, rows[0][1])]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, base string")
    found = {r["doc_id"]: r for r in pii.span_digests(pii.find_spans(df, columns=["doc_id"]), ["doc_id"]).collect()}
    text = rows[0][1]
    at = text.index("bluebird")
    assert f"term:{at}:{at + 8}" in found[0]["spans"] and found[0]["n_email"] == 1
    assert "term" not in found[102]["spans"] and found[102]["n_ip"] == 1 and found[100]["spans"] == ""
    clean = {(r["doc_id"], r["text"]) for r in pii.sanitise_texts(df).collect()}
    texts = dict(clean)
    assert "zed" not in texts[0] and "bluebird" not in texts[0] and "plain words" in texts[0] and texts[100] is None
    assert texts[30] == dict(rows)[30] and pii.sanitise_texts(df).count() == len(rows)
    assert pii.find_spans(df.limit(0), columns=["doc_id"]).count() == 0


def test_terms_of_entities_in_one_or_two_texts(spark):
    """A rare word next to an address seen once or twice discloses it; copies of a text are one encounter."""
    common = "some plain words of every day come here again"
    rows = [(i, f"{common} {i}") for i in range(400)]
    rows += [(1000, f"{common} ask quillon at one@a.org for more words"), (1001, f"{common} ask vexford at two@a.org for plain words"),
             (1002, f"{common} and vexford at two@a.org again")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise_texts(df).collect()}
    assert "quillon" not in clean[1000] and "vexford" not in clean[1001] and "vexford" not in clean[1002]
    assert common.split(" come")[0] in clean[1000] and clean[7] == dict(rows)[7]
    copies = spark.createDataFrame([rows[400]] * 50, "doc_id long, text string")
    assert _pairs(df.unionByName(copies)) == _pairs(df) and ("email:one@a.org", "quillon") in _pairs(df)


def test_terms_are_counted_by_the_names_pairs_have(spark):
    """lower() makes two letters of the Turkish dotted capital I."""
    text = "ask \u0130zmirli at one@a.org for words"
    df = spark.createDataFrame([(0, text)] + [(i, f"plain words {i}") for i in range(1, 400)], "doc_id long, text string")
    assert ("email:one@a.org", "\u0130zmirli".lower()) in _pairs(df)


def _pairs(docs):
    found = pii.scan(docs)
    got = pii.disclosing_pairs(docs, found, pii.encounters(found)).collect()
    return {(r["e"], r["t"]): round(r["disclosure"], 9) for r in got}


def _wilson(n, of):
    p, z = n / of, 1.645**2 / of
    return (p + z / 2 - 1.645 * math.sqrt(p * (1 - p) / of + z / (4 * of))) / (1 + z)


def _brute(rows):
    """Spans by document and the disclosing pairs, for texts whose entities are words of their own."""
    def kind(w):
        return ("email" if "@" in w else "ip" if w.count(".") == 3 else "card" if len(w) == 16 and w.isdigit() else
                "phone" if w[0] == "+" else None)

    def places(text):
        at = 0
        for w in text.split(" "):
            yield w, at
            at += len(w) + 1

    met, of_t, of_e, near = {}, {}, {}, {}
    texts = {t or "" for _, t in rows}
    for text in texts:
        words = list(places(text)) if text else []
        for w in {w for w, _ in words if len(w) > 2 and w.isalpha()}:
            of_t[w] = of_t.get(w, 0) + 1
        for e in {(kind(w), w) for w, _ in words if kind(w)}:
            of_e[e] = of_e.get(e, 0) + 1
        for i, (e, _) in enumerate(words):
            if kind(e):
                for w, at in words[max(0, i - 8):i] + words[i + 1:i + 9]:
                    if len(w) > 2 and w.isalpha():
                        near.setdefault(text, set()).add(((kind(e), e), w, at))
        for pair in {x[:2] for x in near.get(text, ())}:
            met[pair] = met.get(pair, 0) + 1
    told = {(e, w): _wilson(n, of_t[w]) for (e, w), n in met.items()}
    told = {(e, w): d for (e, w), d in told.items() if d >= 0.25 and d**3 >= 2 * of_e[e] / len(texts)}
    spans = {}
    for i, text in rows:
        words = list(places(text)) if text else []
        base = sorted((["email", "ip", "card", "phone"].index(kind(w)), kind(w), at, at + len(w)) for w, at in words if kind(w))
        terms = sorted({(at, at + len(w)) for e, w, at in near.get(text or "", ()) if (e, w) in told})
        spans[i] = ",".join([f"{k}:{a}:{b}" for _, k, a, b in base] + [f"term:{a}:{b}" for a, b in terms])
    return spans, {(f"{k}:{e.lower().lstrip('+')}", w): round(d, 9) for ((k, e), w), d in told.items()}


def _corpus(n, seed):
    r = random.Random(seed)
    entities = ["ann@x.org", "bob@y.net", "10.1.2.3", "4111111111111111", "+15550109999", "zoe@z.de"]
    names = [f"name{c}" for c in "abcdefghij"]
    letters = "abcdefghijklmnopqrstuvwxyz"
    plain = ["".join(r.choice(letters) for _ in range(r.randrange(2, 8))) for _ in range(400)]
    rows = []
    for i in range(n):
        w = [r.choice(plain) for _ in range(r.randrange(1, 40))]
        if i % 5 == 0:
            k = r.randrange(len(entities))
            w.insert(r.randrange(len(w) + 1), entities[k])
            w.insert(r.randrange(len(w) + 1), names[k])
            if r.random() < 0.3:
                w.insert(r.randrange(len(w) + 1), r.choice(entities))
            if r.random() < 0.4:
                w.insert(r.randrange(len(w) + 1), f"only{''.join(r.choice(letters) for _ in range(6))}")
        if r.random() < 0.1:
            w.append(r.choice(names))
        # numbers side by side would read as one
        apart = [x for i, v in enumerate(w) for x in ((["of"] if i and v in entities and w[i - 1] in entities else []) + [v])]
        rows.append((i, " ".join(apart)))
    return rows + [(n, None), (n + 1, "")] + [(n + 2 + i, rows[0][1]) for i in range(n // 3)]


@pytest.mark.parametrize("slots,flush", [(1 << 22, 300_000), (4096, 50)])
def test_disclosure_and_spans_equal_brute_force(spark, monkeypatch, slots, flush):
    """Also with slots shared by many terms, and digests passed on early."""
    monkeypatch.setattr(pii, "SLOTS", slots)
    monkeypatch.setattr(pii, "FLUSH", flush)
    rows = _corpus(600, 3)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    spans, told = _brute(rows)
    assert _pairs(df) == told and any(d >= 0.5 for d in told.values()) and any(d < 0.5 for d in told.values())
    got = {r["doc_id"]: r for r in pii.span_digests(pii.find_spans(df, columns=["doc_id"]), ["doc_id"]).collect()}
    assert {i: r["spans"] for i, r in got.items()} == spans
    assert {k for s in spans.values() for k in re.findall("[a-z]+", s)} == {"email", "ip", "card", "phone", "term"}


def test_equal_evidence_gives_equal_spans_at_every_size(spark):
    """Terms met once, in all of their texts, and in some of them; among 200 and 20,000 texts."""
    told = ["ask quillon at one@a.org today", "vexford holds two@a.org now", "vexford and two@a.org again", "brill of four@a.org", "brill elsewhere",
            *[f"wrendel {i} has three@a.org" for i in range(6)]]
    out = []
    for n in (200, 20_000):
        rows = [(i, f"some plain words of every day {i}") for i in range(n)] + [(n + i, t) for i, t in enumerate(told)]
        clean = pii.sanitise_texts(spark.createDataFrame(rows, "doc_id long, text string"))
        out.append({r["doc_id"] - n: r["text"] for r in clean.where(F.col("doc_id") >= n).collect()})
    assert out[0] == out[1]
    assert out[0][0] == "[WORD] [WORD] at [EMAIL] [WORD]" and out[0][1].startswith("[WORD] [WORD] [EMAIL]")
    assert "brill" in out[0][3] and out[0][5] == "[REMOVED] 0 [REMOVED] [EMAIL]"
