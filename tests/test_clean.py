import re

from hypothesis import given, settings
from hypothesis import strategies as st

from linetally.functions.text import clean_text
from linetally.schema import ALLOWED_CHARACTERS

CASES = [
    ("Crédito  12/03 AÇÚCAR", "crédito açúcar"),
    ("123", ""),
    ("È ñandú", "andú"),
    ("İstanbul", "i stanbul"),
    ("a\u0301b", "a b"),
    ("😀x", "x"),
    ("_A_", "_a_"),
    ("\tx\n", "x"),
    (None, None),
]


def _clean_all(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    out = df.select("i", clean_text("t").alias("c")).collect()
    return [r["c"] for r in sorted(out, key=lambda r: r["i"])]


def test_cases(spark):
    got = _clean_all(spark, [c[0] for c in CASES])
    assert got == [c[1] for c in CASES]


def _kept_words(s):
    return re.findall(f"[{ALLOWED_CHARACTERS}]+", s.lower())


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(min_codepoint=1, max_codepoint=0x2FF) | st.sampled_from("áÁçÇ _-9 \t"), max_size=30), min_size=50, max_size=50))
def test_matches_rule_and_is_idempotent(spark, values):
    got = _clean_all(spark, values)
    allowed = set(ALLOWED_CHARACTERS + " ")
    for v, g in zip(values, got):
        # Python's lower() matches Java's on this range except for the
        # characters whose lower case is longer; compare where equal length.
        if len(v.lower()) == len(v):
            assert g.split() == _kept_words(v), (v, g)
        assert set(g) <= allowed
        assert not g.startswith(" ") and not g.endswith(" ") and "  " not in g
    assert _clean_all(spark, got) == got
