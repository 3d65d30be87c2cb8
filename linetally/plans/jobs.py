"""The jobs a user runs, composed from the operators: row count (A1), text
profile (A18 + S3), cleaned-text export (S5), filtered extract (P10) and the
Pareto report (A19).

Each job takes the same source arguments as the table scan (S1, S2, P1,
P2, L1): a table name or path, optional projection, predicate and limit.
The command-line parser and job dispatcher of the original are not
reproduced; parameters are function arguments.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from ..operators import pareto as _pareto
from ..operators import profile as _profile
from ..operators.extract import filter_rows
from ..schema import PARETO_SHARE, UNDEFINED_CATEGORY, LineColumns
from ..session import materialize
from ..sources import sinks
from ..sources.tables import row_count, scan


@dataclass
class Source:
    """Where the lines come from: ``SELECT fields FROM table [WHERE where]
    [ORDER BY order_by] [LIMIT limit]`` in ``namespace``."""

    table: str | DataFrame
    fields: str | Sequence[str] | None = None
    where: str | Column | None = None
    limit: int | None = None
    order_by: str | Sequence[str | Column] | None = None
    namespace: str | None = None

    def load(self, spark: SparkSession) -> DataFrame:
        return scan(spark, self.table, self.fields, self.where, self.limit, self.order_by, self.namespace)


def count_job(spark: SparkSession, source: Source) -> DataFrame:
    """Number of rows the source query returns (A1)."""
    return row_count(source.load(spark))


@dataclass
class ProfileResult:
    profile: DataFrame
    totals: DataFrame
    groups: DataFrame


def profile_job(
    spark: SparkSession,
    source: Source,
    cols: LineColumns = LineColumns(),
    compat: bool = True,
    strict: bool = True,
    sentinel: str = UNDEFINED_CATEGORY,
    round_to: int | None = None,
    output_table: str | None = None,
) -> ProfileResult:
    """Text profile and totals from one scan of the source; appended to
    ``output_table`` when given (S3). Totals and profile come from the same
    materialised grouped frame, so they always describe the same rows, even
    with an unordered limit."""
    groups = _profile.grouped(source.load(spark), cols, strict, sentinel, materialize=True)
    result = ProfileResult(
        _profile.profile_from_groups(groups, compat, round_to),
        _profile.totals_from_groups(groups),
        groups,
    )
    sinks.append(result.profile, output_table, namespace=source.namespace)
    return result


def export_job(spark: SparkSession, source: Source, id_col: str, text_col: str, output: str, fmt: str = "parquet",
               one_per_id: bool | None = None) -> None:
    """Cleaned-text export (S5) to ``output`` on shared storage."""
    sinks.export_cleaned_texts(source.load(spark), id_col, text_col, output, fmt, one_per_id)


def extract_job(spark: SparkSession, source: Source, column: str, kind: str = "in",
                values: Sequence[str | float] | None = None, output_table: str | None = None,
                delimited_path: str | None = None) -> DataFrame:
    """Filtered extract (P10): the filtered rows, appended to
    ``output_table`` and/or written as ``|``-delimited text when given. With an output, the rows are
    first written to the shared folder, and every output and the returned frame come from that copy: the source is
    scanned once, and all hold the same rows, also under a limit without an order. A
    :class:`linetally.session.Scratch` around the call owns the copy and deletes it."""
    rows = filter_rows(source.load(spark), column, kind, values)
    if output_table or delimited_path:
        rows = materialize(rows, "extract")
    sinks.append(rows, output_table, namespace=source.namespace)
    if delimited_path:
        sinks.export_delimited(rows, delimited_path)
    return rows


def pareto_job(
    spark: SparkSession,
    source: Source,
    cols: LineColumns = LineColumns(),
    share: float = PARETO_SHARE,
    compat: bool = True,
    strict: bool = True,
    sentinel: str = UNDEFINED_CATEGORY,
    output_table: str | None = None,
) -> _pareto.Pareto:
    """Pareto report (A19): the profile ranked by amount and by count share,
    the selections, flags and summary; the flagged profile is appended to
    ``output_table`` when given."""
    groups = _profile.grouped(source.load(spark), cols, strict, sentinel, materialize=True)
    report = _pareto.pareto(groups, share, compat, sentinel)
    sinks.append(report.flags(), output_table, namespace=source.namespace)
    return report
