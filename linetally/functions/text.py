"""Text cleaning (F1) as a single JVM-side column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import ALLOWED_CHARACTERS

# One run of characters outside the allowed set becomes one space; runs of
# spaces are part of such a run, so no separate collapsing pass is needed.
DISALLOWED_RUN = "[^" + ALLOWED_CHARACTERS + "]+"


def clean_text(text: Column | str) -> Column:
    """Lower-case, replace every run of disallowed characters by one space,
    trim both ends.

    Digits, punctuation, whitespace and accents outside the allowed list
    (``è ñ ì ò ï`` …) all become separators, so ``'Crédito  12/03 AÇÚCAR'``
    becomes ``'crédito açúcar'`` and ``'123'`` becomes ``''``. Null stays
    null. Decomposed accents (a letter followed by U+0301) split the word;
    normalise upstream if that is unwanted.
    """
    col = F.col(text) if isinstance(text, str) else text
    return F.trim(F.regexp_replace(F.lower(col), DISALLOWED_RUN, " "))
