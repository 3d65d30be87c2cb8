"""Text profile and row-id lists from one scan (A7 + A18 together).

The original built the id list inside the same aggregation as the profile.
:func:`text_report` does the same in one pass over the source. Every line counts twice: for the
measures of its (text, category), and as an occurrence of its (text, id). Both
are rows of one hash aggregate with numeric buffers, whose result is written once to the shared folder: the
measures by (text, category), and how often each id occurs under each text. The profile, the totals and the id
chunks are then all derived from it, and the source is scanned once, also when ids
repeat. Use :func:`linetally.operators.profile.text_profile` when the
ids are not needed: it shuffles no ids.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import DEFAULT_ID_SPAN, UNDEFINED_CATEGORY, LineColumns
from ..session import materialize as _materialize
from .idlists import cells_of
from .profile import (
    DEFAULT_COLUMNS,
    is_exact,
    line_measures,
    merge_categories,
    prepared_lines,
    profile_from_groups,
    summable,
    totals_from_groups,
)


_MEASURES, _IDS = 0, 1


@dataclass
class TextReport:
    fine: DataFrame  # one row per (text, category) with measures, and one per (text, id) with its occurrences
    span: int
    sentinel: str = UNDEFINED_CATEGORY
    materialize: bool = True
    _groups: DataFrame | None = None

    def groups(self) -> DataFrame:
        """One row per text, as :func:`.profile.text_groups`; written when first asked for, so that profile and totals share it."""
        if self._groups is None:
            groups = merge_categories(self.fine.where(F.col("_kind") == _MEASURES).drop("_kind", "_id"), self.sentinel)
            self._groups = _materialize(groups, "report-groups") if self.materialize else groups
        return self._groups

    def profile(self, compat: bool = True, round_to: int | None = None) -> DataFrame:
        return profile_from_groups(self.groups(), compat, round_to)

    def totals(self) -> DataFrame:
        return totals_from_groups(self.groups())

    def id_chunks(self, keep_empty: bool = False) -> DataFrame:
        """As :func:`.idlists.text_id_chunks`: ``text``, ``chunk``, ``part``,
        ``first_id``, ``last_id``, ``n_ids``, ``row_ids``."""
        occurrences = self.fine.where(F.col("_kind") == _IDS).select("text", "_id", F.col("cnt").alias("_m"))
        if not keep_empty:
            occurrences = occurrences.where(F.col("text") != F.lit(""))
        return cells_of(occurrences, ["text"], self.span, "row_ids")


def text_report(
    lines: DataFrame,
    cols: LineColumns = DEFAULT_COLUMNS,
    span: int = DEFAULT_ID_SPAN,
    strict: bool = True,
    sentinel: str = UNDEFINED_CATEGORY,
    materialize: bool = True,
) -> TextReport:
    """Aggregate ``lines`` once, by (text, category) and by (text, id), and, when
    ``materialize`` (an action), write that frame to the shared folder."""
    if span < 1:
        raise ValueError("span must be >= 1")
    p = summable(prepared_lines(lines, cols, strict), cols).withColumn("_kind", F.explode(F.array(F.lit(_MEASURES), F.lit(_IDS))))
    as_id = F.col("_kind") == _IDS
    # an occurrence has no measures, and a measured line no id
    p = p.withColumn("_id", F.when(as_id, F.col("row_id")))
    p = p.withColumns({c: F.when(~as_id, F.col(c)) for c in p.columns if c not in ("_kind", "_id", "text")})
    fine = p.groupBy("_kind", "text", "category", "_id").agg(*line_measures(is_exact(cols)))
    if materialize:
        fine = _materialize(fine, "text-report")
    return TextReport(fine, span, sentinel, materialize)
