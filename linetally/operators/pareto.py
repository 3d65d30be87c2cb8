"""Pareto selection over the text profile (A13-A16, F9).

The head of the distribution is the ``ceil(U * share)`` texts with the
largest share of the amount (and, separately, of the count), where ``U`` is
the number of distinct cleaned texts *including* the empty one, and ties
are broken by the text. Selected rows are flagged with 1, others with null,
and each selection is summarised by its amount and by how many of its texts
have a real category or the undefined one.

Which texts are selected is found by :mod:`.cut`, without sorting: flags and summary
are conditions on the profile, which is written once. Only a selection, whose rows carry their ranks, is
sorted, and only its own rows (:mod:`.ranking`). The empty text counts
towards ``U`` but is never selected.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exact_sum import sum_doubles
from ..schema import PARETO_SHARE, PROFILE_COLUMNS, UNDEFINED_CATEGORY
from ..session import materialize
from .cut import head
from .profile import profile_from_groups
from .ranking import rank_rows


def selection_size(unique_texts: int, share: float = PARETO_SHARE) -> int:
    """``ceil(U * share)`` in double arithmetic, as the original computed it
    (for share 0.2 this equals ``ceil(U / 5)`` for every U below 200,000)."""
    if not 0 <= share <= 1:
        raise ValueError("share must be in [0, 1]")
    return int(math.ceil(unique_texts * float(share)))


class Pareto:
    """The profile of a grouped frame, and its heads by amount share and by count
    share. The profile is written to the shared folder and each head's cut is looked for
    (:func:`.cut.head`: a few small aggregates) when a result first needs it."""

    def __init__(self, groups: DataFrame, share: float = PARETO_SHARE, compat: bool = True,
                 sentinel: str = UNDEFINED_CATEGORY, round_to: int | None = None):
        # The empty text counts towards U, but is never selected.
        self._lazy_profile = profile_from_groups(groups, compat, round_to)
        kind = groups.schema["amount"].dataType
        self._amount_type = kind if isinstance(kind, T.DecimalType) else T.DoubleType()
        self.sentinel = sentinel
        self.unique_texts = groups.count()  # one small action on the grouped frame
        self.n = selection_size(self.unique_texts, share)
        self._cuts: dict[str, Column] = {}
        self._profile_copy: DataFrame | None = None

    @property
    def _profile(self) -> DataFrame:
        if self._profile_copy is None:
            self._profile_copy = materialize(self._lazy_profile, "pareto-profile")
        return self._profile_copy

    def selected(self, by: str) -> Column:
        """Condition for the profile rows that ``by`` in ``{"amount", "count"}`` selects (a few small actions, once)."""
        if by not in ("amount", "count"):
            raise ValueError("by must be 'amount' or 'count'")
        if by not in self._cuts:
            self._cuts[by] = head(self._profile.select("text", f"percentual_{by}"), f"percentual_{by}", "text", self.n)
        return self._cuts[by]

    def selection(self, by: str = "amount") -> DataFrame:
        """The selected profile rows for ``by`` in ``{"amount", "count"}``,
        with their ``rank`` (A13, A14): these rows alone are sorted."""
        order = [F.col(f"percentual_{by}").desc_nulls_last(), F.col("text").asc()]
        return rank_rows(self._profile.where(self.selected(by)), order, "rank", f"pareto-{by}").frame.select(*PROFILE_COLUMNS, "rank")

    def flags(self) -> DataFrame:
        """All profile rows with ``pareto_amount`` and ``pareto_count``: 1 if
        selected by that ranking, else null (A15)."""
        flag = lambda by: F.when(self.selected(by), F.lit(1)).cast(T.IntegerType()).alias(f"pareto_{by}")
        return self._profile.select(*PROFILE_COLUMNS, flag("amount"), flag("count"))

    def summary(self) -> DataFrame:
        """Two rows, ``ranking`` = amount / count: the selection's amount and
        the numbers of its texts with a real or the undefined category (A16)."""
        undefined = F.col("category") == F.lit(self.sentinel)
        rankings = ("amount", "count")
        names = F.array(*[F.when(self.selected(by), F.lit(by)) for by in rankings])
        # a row for each selection that a text is in
        chosen = self._profile.select(F.explode(names).alias("ranking"), "amount", "category").where(F.col("ranking").isNotNull())
        counts = chosen.groupBy("ranking").agg(F.count_if(~undefined).alias("categorised_groups"), F.count_if(undefined).alias("undefined_groups"),
                                               F.sum(F.col("amount").cast(self._amount_type)).cast("double").alias("amount"))
        if isinstance(self._amount_type, T.DoubleType):
            counts = counts.drop("amount").join(sum_doubles(chosen, ["ranking"], "amount", "amount"), "ranking")
        both = self._profile.sparkSession.createDataFrame([(r,) for r in rankings], "ranking string")
        zero = F.lit(0).cast("bigint")
        return both.join(counts, "ranking", "left").select(
            "ranking", F.coalesce("amount", F.lit(0.0)).alias("amount"), F.coalesce("categorised_groups", zero).alias("categorised_groups"),
            F.coalesce("undefined_groups", zero).alias("undefined_groups"))


def pareto(
    groups: DataFrame,
    share: float = PARETO_SHARE,
    compat: bool = True,
    sentinel: str = UNDEFINED_CATEGORY,
    round_to: int | None = None,
) -> Pareto:
    """Pareto report over ``groups`` (see :func:`.profile.text_groups`;
    pass a materialised copy, e.g. :func:`.profile.grouped`). Counting the
    distinct texts is an action; each cut is looked for on first use."""
    return Pareto(groups, share, compat, sentinel, round_to)
