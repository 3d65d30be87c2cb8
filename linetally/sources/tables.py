"""Table scan (S1) with namespace (S2), projection (P1), free predicate (P2)
and limit (L1).

The scan is a lazy DataFrame: the projection and the predicate reach the
Parquet reader as ``ReadSchema`` and ``PushedFilters``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _is_path(source: str) -> bool:
    return "/" in source or source.endswith(".parquet")


def read_table(spark: SparkSession, source: str, namespace: str | None = None, fmt: str = "parquet") -> DataFrame:
    """A catalog table (``db.table``, or ``table`` resolved in ``namespace``
    or the current database) or a path in ``fmt``."""
    if _is_path(source):
        return spark.read.format(fmt).load(source)
    name = source if (namespace is None or "." in source) else f"{namespace}.{source}"
    return spark.table(name)


def split_fields(text: str) -> list[str]:
    """Split a SQL select list on its top-level commas (not those inside
    parentheses, brackets or quotes): ``"a, concat(b, c) AS d"`` gives
    ``["a", "concat(b, c) AS d"]``."""
    parts, depth, quote, cur = [], 0, None, []
    for ch in text:
        if quote:
            if ch == quote:
                quote = None
        elif ch in "'\"`":
            quote = ch
        elif ch in "([":
            depth += 1
        elif ch in ")]":
            depth -= 1
        elif ch == "," and depth == 0:
            parts.append("".join(cur))
            cur = []
            continue
        cur.append(ch)
    parts.append("".join(cur))
    return [p.strip() for p in parts if p.strip()]


def _fields(fields: str | Sequence[str] | None) -> list[str]:
    if fields is None:
        return []
    if isinstance(fields, str):
        return split_fields(fields)
    return [f.strip() for f in fields if f.strip()]


def scan(
    spark: SparkSession,
    source: str | DataFrame,
    fields: str | Sequence[str] | None = None,
    where: str | Column | None = None,
    limit: int | None = None,
    order_by: str | Sequence[str | Column] | None = None,
    namespace: str | None = None,
) -> DataFrame:
    """``SELECT fields FROM source [WHERE where] [ORDER BY order_by] [LIMIT limit]``.

    ``fields`` is a list or a comma-separated string of SQL expressions
    (commas inside function calls and quotes are kept); empty means all
    columns. ``limit`` without ``order_by`` returns *some* n rows,
    as in the original; with ``order_by`` they are the first n (a top-k, not
    a global sort). ``order_by`` alone sorts the result.
    """
    df = source if isinstance(source, DataFrame) else read_table(spark, source, namespace)
    if where is not None and (not isinstance(where, str) or where.strip()):
        df = df.where(where)
    cols = _fields(fields)
    if cols:
        df = df.selectExpr(*cols)
    if order_by is not None:
        keys = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
        df = df.orderBy(*keys)
    if limit is not None:
        if int(limit) < 0:
            raise ValueError("limit must be >= 0")
        df = df.limit(int(limit))
    return df


def row_count(df: DataFrame) -> DataFrame:
    """Number of rows of a query (A1), as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))
