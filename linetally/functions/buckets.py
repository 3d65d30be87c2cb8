"""Scalar helpers: percentage bucket (F2), number parsing (F5), hour and day
parts (F3, F4), the null check of strict mode and money conversion.

All of them return plain ``Column`` expressions, so they stay inside
whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import (
    BUCKET_BOUNDS,
    DIA_HOURS,
    MADRUGADA_HOURS,
    NOITE_START_HOUR,
    TARDE_HOURS,
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_double(value: Column | str, strict: bool = True) -> Column:
    """String (or number) to double.

    ``strict=True`` uses a plain cast, which under ANSI mode fails the job on
    a malformed value, as parsing did in the original program;
    ``strict=False`` turns malformed values into null.
    """
    v = _col(value)
    return v.cast(T.DoubleType()) if strict else v.try_cast(T.DoubleType())


def percentage_bucket(pct: Column | str) -> Column:
    """(0, 25] -> 1, (25, 50] -> 2, (50, 75] -> 3, (75, 100] -> 4, else 0.

    Both bounds are tested in every branch, so values <= 0, > 100, NaN and
    null all land in bucket 0.
    """
    p = _col(pct)
    out = F.lit(0)
    expr = None
    for i in range(1, len(BUCKET_BOUNDS)):
        lo, hi = BUCKET_BOUNDS[i - 1], BUCKET_BOUNDS[i]
        cond = (p > F.lit(lo)) & (p <= F.lit(hi))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(out).cast(T.IntegerType())


def hour_of_day(ts: Column | str) -> Column:
    """Hour 0-23. ``timestamp_ntz`` values need no zone; for zoned
    timestamps the session time zone decides, so pin it."""
    return F.hour(_col(ts))


def _in_range(h: Column, bounds: tuple[int, int]) -> Column:
    return (h >= F.lit(bounds[0])) & (h < F.lit(bounds[1]))


def is_madrugada(hour: Column) -> Column:
    return _in_range(hour, MADRUGADA_HOURS)


def is_dia(hour: Column) -> Column:
    return _in_range(hour, DIA_HOURS)


def is_tarde(hour: Column) -> Column:
    return _in_range(hour, TARDE_HOURS)


def is_noite(hour: Column, compat: bool = True) -> Column:
    """Night.

    ``compat=True`` reproduces the original program, where the *noite*
    branch was the ``else`` of the afternoon test only: every hour outside
    [12, 18) counts as night (so hours 0-11 count twice, as madrugada or
    dia and as noite). ``compat=False`` is the evident intent: hour >= 18.
    """
    if compat:
        return ~_in_range(hour, TARDE_HOURS)
    return hour >= F.lit(NOITE_START_HOUR)


def money(amount: Column | str, amount_type: str = "double") -> Column:
    """Amount to be summed.

    ``double`` (the default) sums the values as they are, as the original
    did. An exact type such as ``decimal(18,2)`` makes sums independent of
    the order in which partitions are merged; a value that does not fit it
    exactly fails the job, it is never rounded. A NaN or infinite amount fails
    the job in either case."""
    a = _col(amount)
    as_double = a.cast(T.DoubleType())
    non_finite = F.isnan(as_double) | (F.abs(as_double) == F.lit(float("inf")))
    checked = F.when(non_finite, F.raise_error(F.lit("non-finite amount")))
    if amount_type == "double":
        return checked.otherwise(as_double)
    exact = a.cast(amount_type)
    inexact = exact.cast(T.DoubleType()) != as_double
    return checked.when(inexact, F.raise_error(F.lit(f"amount does not fit {amount_type}"))).otherwise(exact)


def required(value: Column | str, strict: bool, name: str) -> Column:
    """``value``; if ``strict``, a null fails the job, as reading it did in the original."""
    v = _col(value)
    return F.when(v.isNull(), F.raise_error(F.lit(f"null {name}"))).otherwise(v) if strict else v


def to_double(c: Column | str) -> Column:
    return _col(c).cast(T.DoubleType())


def share(part: Column, whole: Column) -> Column:
    """part / whole as double; a zero or null whole gives null instead of an
    error under ANSI mode."""
    return F.try_divide(part.cast(T.DoubleType()), whole.cast(T.DoubleType()))
