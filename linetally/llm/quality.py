"""Quality rules, line first (native).

Every line of a text is judged on its own: does it end like a sentence, is it
a navigation bar, is it boilerplate, is it mostly symbols? Failing lines are
removed, and a document that loses too much of its text, or that breaks a
base rule (too few words, too much repeated text), is rejected.

Everything is one projection over the document row: no shuffle, no Python.

Results for odd input: a null text counts as empty; an empty text has all
counts 0 and is rejected (fewer than :data:`MIN_WORDS` words); repeated rows
are judged alike, each kept in the result; very long texts are read whole. The
sort that finds repeated windows runs only for texts that have some.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, carried, lower_ascii, whole_text, words

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Characters (code points) of lines that may be removed before the document goes.
MAX_LOST_PERCENT = 50
SYMBOLS = r"[#*$%&|<>]"
#: A line needs a sentence end (of any script), closing quotes and brackets allowed after it.
SENTENCE_END = (
    r"[.!?:;,\x{2026}\x{203D}\x{0589}\x{061B}\x{061F}\x{06D4}\x{0964}\x{0965}\x{0F0D}\x{104A}\x{104B}\x{1362}-\x{1368}"
    r"\x{17D4}\x{17D5}\x{3001}\x{3002}\x{FF01}\x{FF0C}\x{FF0E}\x{FF1A}\x{FF1B}\x{FF1F}\x{FF61}]"
    r"[\"')\]\x{00AB}\x{00BB}\x{2018}\x{2019}\x{201C}\x{201D}\x{2039}\x{203A}\x{3009}\x{300B}\x{300D}\x{300F}\x{3011}\x{FF02}\x{FF09}]*$"
)
#: Characters of a menu's cell.
CELL = 40


def _menu(separator: str, partner: str = "") -> str:
    """Lines that start with two short cells and end with one, neither with the separator's partner in it."""
    other = f"[^{separator}{partner}]"
    return f"^{other}{{0,{CELL}}}{separator}{other}{{1,{CELL}}}{separator}([^\\n]*{separator})?{other}{{0,{CELL}}}$"


#: Menus: short cells divided by bars, arrows or bullets. Quotes and tags pair » with « and > with <.
NAVIGATION = "|".join([_menu(r"\|"), _menu(r"\x{00BB}", r"\x{00AB}"), _menu(">", "<"), _menu(r"\x{2022}")])
#: Phrases of site furniture, lower case.
PHRASES = (
    "cookies?", "privacy policy", "terms of use", "terms of service", "all rights reserved", "javascript",
    "click here", "read more", "sign in", "sign up", "log in", "subscribe", "newsletters?", "lorem ipsum",
    "skip to content", "share this",
)
#: Words on either side of a phrase that leave the line short.
SHORT = 12
#: Whole phrases in short lines. Loops over words are bounded, as Java's recurse.
BOILERPLATE = (
    r"^([^\x20\x09-\x0D]+[\x20\x09-\x0D]+){0," + str(SHORT) + r"}([^\x20\x09-\x0D]*[^\p{L}\p{N}\x20\x09-\x0D])?("
    + "|".join(PHRASES)
    + r")([^\p{L}\p{N}\x20\x09-\x0D][^\x20\x09-\x0D]*)?([\x20\x09-\x0D]+[^\x20\x09-\x0D]+){0," + str(SHORT) + "}$",
)
MAX_SYMBOL_PERCENT = 10


def symbol_count(text: Column) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))


def line_fails(line: Column) -> Column:
    """True for a line with words that breaks a line rule."""
    body = F.btrim(line, F.lit(SPACES))
    return (
        ~F.rlike(body, F.lit(SENTENCE_END))
        | F.rlike(body, F.lit(NAVIGATION))
        | F.rlike(lower_ascii(body), F.lit("|".join(BOILERPLATE)))
        | (F.lit(100) * symbol_count(body) > F.lit(MAX_SYMBOL_PERCENT) * F.length(body))
    )


def _has_word(line: Column) -> Column:
    return F.length(F.btrim(line, F.lit(SPACES))) > 0


def _repeated_words(h: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more, from the
    array of window hashes in text order."""
    pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(h)) < F.size(h), pairs)


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``lost_chars`` (in failing lines),
    ``line_chars`` (in all lines with words), ``cleaned_text`` (the lines that
    passed, blank lines dropped) and ``kept``. Input columns of these names
    are replaced."""
    made = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "lost_chars",
            "line_chars", "cleaned_text", "kept")
    d = docs.select(*[F.col(f"`{c}`") for c in carried(docs, made)], whole_text(text).alias("_text"))
    d = d.withColumns({"_words": words(F.col("_text")),
                       "_lines": F.filter(F.split(F.col("_text"), "\n", -1), _has_word)})
    w = F.col("_words")
    n = F.size(w)
    starts = F.sequence(F.lit(0), n - WINDOW)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
    d = d.withColumns({
        "_h": F.when(n >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>")),
        "n_words": n.cast("long"),
        "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_symbols": symbol_count(F.col("_text")).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_passed": F.filter("_lines", lambda x: ~line_fails(x)),
    })
    # windows sorted by hash, only where some hash repeats (null otherwise)
    d = d.withColumn("_sorted", _repeated_words(F.col("_h")))
    s = F.col("_sorted")
    repeats = F.filter(s, lambda e, i: (F.get(s, i - 1)["h"] == e["h"]) | (F.get(s, i + 1)["h"] == e["h"]))
    d = d.withColumn("_at", F.array_sort(F.transform(repeats, lambda e: e["i"])))
    at = F.col("_at")
    # each repeated window covers its words up to where the next one starts
    covers = F.transform(at, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW))))
    chars = lambda c: F.length(F.array_join(c, "")).cast("long")
    d = d.withColumns({
        "n_repeat_words": F.coalesce(F.aggregate(covers, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long"),
        "line_chars": chars("_lines"),
        "lost_chars": chars("_lines") - chars("_passed"),
        "cleaned_text": F.array_join("_passed", "\n"),
    })
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words"))
    loses = F.lit(100) * F.col("lost_chars") > F.lit(MAX_LOST_PERCENT) * F.col("line_chars")
    return d.withColumns({"base_failed": failed, "kept": ~failed & ~loses}).drop(
        "_text", "_words", "_lines", "_passed", "_h", "_sorted", "_at")
