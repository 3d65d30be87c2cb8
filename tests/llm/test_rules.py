"""URL filter, quality rules and license scan on odd rows."""

from linetally.llm import licenses, quality, urls
from linetally.llm.queries import RULES


def test_urls(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://A.Net/x"), (4, "http://net"), (5, "https://x.example.net/en/1?q#f"),
            (6, "http://example.com/de/"), (7, "http://badexample.com/de/"), (8, "http://fr.org/fr/"), (8, "http://fr.org/fr/"),
            (9, "http://evilnet/"), (10, "http://u.net:80/")]
    got = sorted((r["page_id"], r["host"], r["rule"], r["verdict"]) for r in urls.judge_urls(
        spark.createDataFrame([(i, u, "x") for i, u in rows], "page_id long, url string, host string"), RULES).collect())
    assert got == sorted([
        (1, "", None, "allow"), (2, "", None, "allow"), (3, "a.net", "net/", "block"), (4, "net", None, "allow"),
        (5, "x.example.net", "example.net/en/", "allow"), (6, "example.com", "example.com/de/", "block"),
        (7, "badexample.com", None, "allow"), (8, "fr.org", "org/fr/", "allow"), (8, "fr.org", "org/fr/", "allow"),
        (9, "evilnet", None, "allow"), (10, "u.net:80", None, "allow")], key=lambda x: (x[0],))
    empty = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge_urls(empty, RULES).count() == 0


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20_000).selectExpr("concat('k', id) AS key")
    listed = universe.where("cast(substr(key, 2) AS int) % 40 = 0")
    cascade = urls.build_cascade(listed, universe)
    assert len(cascade.levels) > 1
    wrong = universe.where(cascade.listed(universe["key"]) != (universe["key"].substr(2, 9).cast("int") % 40 == 0))
    assert wrong.count() == 0


def _brute(text):
    w = (text or "").translate({ord(c): " " for c in "\t\n\x0b\x0c\r"}).split(" ")
    w = [x for x in w if x]
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    hit = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)


def test_quality_counts(spark):
    texts = [None, "", " \n\t", "a b c d e f a b c d e g", "x y z w v " * 9, "Line one.\nLine one.\n\nLine two | b | c", "é" * 50_000,
             "# * é b c", "one two three four five six seven eight nine ten."]
    df = spark.createDataFrame([(i, t, True) for i, t in enumerate(texts)], "doc_id long, text string, kept boolean")
    got = {r["doc_id"]: r for r in quality.judge(df).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == _brute(t), t
    assert got[8]["kept"] and not got[0]["kept"]
    assert quality.judge(df.limit(0)).count() == 0


def test_line_rules(spark):
    text = "Home | About | Contact\nThis is a real sentence with words in it.\nWe use cookies to improve.\nno end here"
    r = quality.judge(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r["cleaned_text"] == "This is a real sentence with words in it." and not r["kept"]


def test_licenses(spark):
    t = licenses.TEMPLATES[2].text
    rows = [(1, "some other words here\nReleased under the MIT license!\nand more of them"), (2, None), (3, ""), (4, "MIT"), (5, t[:100] + "\n" + t[100:220] + "\n" + t[220:]),
            (6, "The license of this text is not known.")]
    df = spark.createDataFrame([(i, x, "c") for i, x in rows], "doc_id long, text string, kind string")
    got = sorted((r["doc_id"], r["kind"], r["segment"], r["license"]) for r in licenses.scan_licenses(df).collect())
    assert got == [(1, "line", 1, "MIT"), (5, "paragraph", 0, "MIT")]


def test_variants_of_licenses_are_named(spark):
    work, gnu = "This work is licensed under ", "it under the terms of the GNU {} as published by the Free Software Foundation, "
    later = "either version {} of the License, or (at your option) any later version."
    free = "This program is free software: you can redistribute it and/or modify " + gnu + later
    rows = [("CC-BY-NC-4.0", work + "a Creative Commons Attribution-NonCommercial 4.0 International License."),
            ("CC-BY-SA-4.0", work + "a Creative Commons Attribution-ShareAlike 4.0 International License."),
            ("CC-BY-NC-ND-4.0", work + "a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
            ("CC-BY-4.0", work + "a Creative Commons Attribution 4.0 International License."),
            ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."), ("GPL-2.0", work + "the GNU General Public License, version 2."),
            ("LGPL-3.0", work + "the GNU Lesser General Public License, version 3."),
            ("GPL-2.0", free.format("General Public License", "2")), ("GPL-3.0", free.format("General Public License", "3")),
            ("AGPL-3.0", free.format("Affero General Public License", "3")),
            ("LGPL-2.1", free.format("Lesser General Public License", "2.1").replace("program", "library")),
            ("LGPL-3.0", free.format("Lesser General Public License", "3")),
            ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0")]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: r["license"] for r in licenses.scan_licenses(df).collect()}
    assert [got.get(i) for i in range(len(rows))] == [x for x, _ in rows]


def test_prose_is_no_site_furniture(spark):
    long = "and then the story goes on for many more words " * 4
    good = ["Il dit « oui », puis « non ».", "»Ja«, sagte er, »nein«, sagte sie.", "Er sagte: »Nein.«", "The values a > b and then, in the other case which is long, c > d.",
            "Use <b>bold</b> only for the few words that really matter to the reader.", "The design industry grew.", "An analog input, or a blog in French.", f"{long}cookie and newsletter {long}end.",
            "这是一个句子。", "यह एक वाक्य है।", "هل هذه جملة؟", "A > B > C is the order " + long + "to the end."]
    bad = ["Home > News > Sport.", "» Home » News » Sport.", "• One • Two • Three.", "Home | News | Sport.", " | ".join(["cell"] * 5000) + ".",
           "Please sign in.", "Read more...", "This site uses (cookies)."]
    df = spark.createDataFrame(list(enumerate(good + bad)), "doc_id long, text string")
    passed = {r["doc_id"] for r in quality.judge(df).collect() if r["cleaned_text"]}
    assert passed == set(range(len(good))), [(good + bad)[i] for i in passed ^ set(range(len(good)))]
