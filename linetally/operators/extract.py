"""Filtered extract (P5-P8): membership, strictly-greater and inclusive range
filters on one column.

Each filter is a plain predicate with literal bounds, so Catalyst pushes it
into the Parquet scan (``PushedFilters``) and through joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILTER_KINDS = ("in", "greater", "between")


def filter_predicate(df: DataFrame, column: str, kind: str = "in", values: Sequence[str | float] | None = None) -> Column:
    """The predicate for ``kind``:

    * ``in``: the column equals one of ``values`` (given as strings, as on a
      command line; each is cast to the column's type, so a malformed number
      fails under ANSI mode instead of silently matching nothing);
    * ``greater``: column > ``values[0]`` (as double);
    * ``between``: ``values[0]`` <= column <= ``values[1]`` (as doubles).

    An unknown kind or missing bounds raise ``ValueError`` (the original
    copied the whole table for an unknown kind and failed later on missing
    bounds).
    """
    if kind not in FILTER_KINDS:
        raise ValueError(f"unknown filter kind {kind!r}; expected one of {FILTER_KINDS}")
    if values is None:
        raise ValueError(f"filter kind {kind!r} needs values")
    values = list(values)
    c = F.col(column)
    if kind == "in":
        if not values:
            raise ValueError("filter kind 'in' needs at least one value")
        dtype = df.schema[column].dataType
        lits = [F.lit(str(v)) if isinstance(dtype, T.StringType) else F.lit(str(v)).cast(dtype) for v in values]
        return c.isin(*lits)
    if kind == "greater":
        if len(values) < 1:
            raise ValueError("filter kind 'greater' needs one value")
        return c > F.lit(float(values[0]))
    if len(values) < 2:
        raise ValueError("filter kind 'between' needs two values")
    return c.between(F.lit(float(values[0])), F.lit(float(values[1])))


def filter_rows(df: DataFrame, column: str, kind: str = "in", values: Sequence[str | float] | None = None) -> DataFrame:
    """``df`` restricted by :func:`filter_predicate`."""
    return df.where(filter_predicate(df, column, kind, values))
