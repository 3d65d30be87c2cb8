"""The head of an order without sorting it: which rows are the first n by a
number, descending, and then by a text.

A histogram of the numbers is refined around the n-th one until a single value is
left: the cut. Each step is one aggregate, of which the driver gets at most
:data:`BINS` counts. Rows above the cut are in, rows below are out. Only if the rows at the
cut are too many does their text decide, and in the same way: seven bytes of it are read
as a number, from where the texts still in question differ. So neither rows nor
texts are sorted or sent to the driver, and the result is a condition, made of
numbers, that any frame with the two columns can be filtered by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 1024
#: Bytes of a text compared at a time: they fit a long.
BYTES = 7


def nth(rows: DataFrame, key: Column, n: int) -> tuple[float | int, int, int]:
    """The n-th smallest ``key`` (from 1; no nulls), the number of rows below it, and of those equal to it. One aggregate a step: every step
    keeps one of :data:`BINS` equal parts of the range that is left, and the least and the greatest key are never in the same part."""
    rows = rows.select(key.alias("_k"))
    low, high, here = rows.agg(F.min("_k"), F.max("_k"), F.count(F.lit(1))).first()
    below = 0
    while low < high:
        share = (F.col("_k") - F.lit(low)).cast("double") / F.lit(float(high - low))
        part = F.least(F.floor(share * BINS), F.lit(BINS - 1))
        inside = rows.where((F.col("_k") >= F.lit(low)) & (F.col("_k") <= F.lit(high)))
        parts = inside.groupBy(part.alias("_b")).agg(F.count(F.lit(1)), F.min("_k"), F.max("_k")).collect()
        for _, here, low, high in sorted(parts, key=lambda p: p[0]):
            if below + here >= n:
                break
            below += here
    return low, below, here


def _text_key(text: Column, offset: int) -> Column:
    """The bytes from ``offset`` on as a number that sorts like them; a text that has ended sorts first."""
    piece = F.hex(F.substring(F.encode(text, "UTF-8"), offset + 1, BYTES))
    return F.conv(F.rpad(piece, 2 * BYTES, "0"), 16, 10).cast("bigint")


def _first_difference(rows: DataFrame, text: str) -> int:
    """Bytes that all texts of ``rows`` have in common at their start. The driver gets the number."""
    ends = rows.agg(F.hex(F.encode(F.min(text), "UTF-8")).alias("a"), F.hex(F.encode(F.max(text), "UTF-8")).alias("b"))
    halves = F.zip_with(F.split("a", "(?<=\\G..)"), F.split("b", "(?<=\\G..)"), lambda x, y: F.coalesce(x == y, F.lit(False)))
    place = F.array_position(halves, False)
    return int(ends.select(F.when(place > 0, place - 1).otherwise(F.size(halves))).first()[0])


def _text_cut(rows: DataFrame, text: str, n: int) -> Column:
    """Condition for the first n of ``rows`` by text (which are different)."""
    offset = _first_difference(rows, text)
    key = _text_key(F.col(text), offset)
    value, below, here = nth(rows, key, n)
    if below + here == n:
        return key <= F.lit(value)
    return (key < F.lit(value)) | ((key == F.lit(value)) & _text_cut(rows.where(key == F.lit(value)), text, n - below))


def head(rows: DataFrame, value: str, text: str, n: int) -> Column:
    """Condition, on columns ``value`` and ``text``, for the first n of ``rows`` by ``value`` descending (nulls last), then ``text``
    ascending (by bytes). Texts are different and have no null character. Several small actions; ``rows`` should be a written table."""
    number = F.col(value)
    known, total = rows.agg(F.count(value), F.count(F.lit(1))).first()
    if n >= total:
        return F.lit(True)
    if n <= 0:
        return F.lit(False)
    if n == known:
        return number.isNotNull()
    if n > known:
        return number.isNotNull() | _text_cut(rows.where(number.isNull()), text, n - known)
    minus, below, here = nth(rows.where(number.isNotNull()), -number, n)
    cut = F.lit(-minus)
    if below + here == n:
        return F.coalesce(number >= cut, F.lit(False))
    return F.coalesce((number > cut) | ((number == cut) & _text_cut(rows.where(number == cut), text, n - below)), F.lit(False))
