"""Client profile (A17): per cleaned text and institution, the number of
lines, their value, a representative category, the clients (user ids) and
how many distinct clients there are.

This operator is *inferred*: the original only declares its output record
(text, count, value, category, prefix, institution, clients,
count_clients) and passes the institution and user-id column names; no code
computes it. ``prefix`` has no evidence and is left out; ``clients`` is
taken to be distinct user ids, and like the row id list it is a relation of
bounded chunks (:func:`client_lists`), not one cell per group.

Plan: one hash aggregate by (text, institution, user, category) with
numeric buffers does the heavy reduction; everything after it runs on that
reduced frame, again as hash aggregates (see
:func:`profile_from_client_lines`). A frequent text is spread over tasks by
user in the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.buckets import money, to_double
from ..functions.text import clean_text
from ..schema import DEFAULT_ID_SPAN, LineColumns
from ..session import materialize as _materialize
from .idlists import id_chunks, ranked_id_chunks
from .profile import DEFAULT_COLUMNS, amount_sums, finish_amount, gate, is_exact, summable


def client_lines(lines: DataFrame, cols: LineColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Per (text, institution, user, category): ``cnt``, the amount (for doubles the sums of its digits)
    and ``first_id``. Rows pass the profile gate and need a user
    id (P9)."""
    g = gate(lines, cols).where(F.col(cols.user_id).isNotNull()).select(
        clean_text(F.col(cols.text).cast(T.StringType())).alias("text"),
        F.col(cols.institution).alias("institution"),
        F.col(cols.user_id).alias("user_id"),
        F.col(cols.category).alias("category"),
        F.col(cols.row_id).cast(T.LongType()).alias("row_id"),
        money(cols.amount, cols.amount_type).alias("amount"),
    )
    return summable(g, cols).groupBy("text", "institution", "user_id", "category").agg(
        F.count(F.lit(1)).alias("cnt"), *amount_sums(is_exact(cols)), F.min("row_id").alias("first_id"))


def profile_from_client_lines(reduced: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Columns ``text``, ``institution``, ``count``, ``value``,
    ``category`` (of the line with the least row id) and ``count_clients``.

    One row per (text, institution, user) first, then one per (text,
    institution), so distinct clients are counted without a join and a null
    institution is a group like any other.
    """
    r = reduced if keep_empty else reduced.where(F.col("text") != F.lit(""))
    keys = ["text", "institution"]
    exact = "amount" not in reduced.columns
    per_user = r.groupBy(*keys, "user_id").agg(
        F.sum("cnt").alias("cnt"), *amount_sums(exact), F.min(F.struct("first_id", "category")).alias("rep")
    )
    groups = per_user.groupBy(*keys).agg(
        F.sum("cnt").cast(T.LongType()).alias("count"),
        *amount_sums(exact),
        F.min("rep").alias("rep"),
        F.count(F.lit(1)).alias("count_clients"),
    )
    return finish_amount(groups, exact).select("text", "institution", "count", to_double("amount").alias("value"),
                                               F.col("rep.category").alias("category"), "count_clients")


def client_profile(lines: DataFrame, cols: LineColumns = DEFAULT_COLUMNS, keep_empty: bool = False) -> DataFrame:
    """The client profile (lazy)."""
    return profile_from_client_lines(client_lines(lines, cols), keep_empty)


def client_lists(reduced: DataFrame, span: int = DEFAULT_ID_SPAN, keep_empty: bool = False) -> DataFrame:
    """Distinct user ids per (text, institution) as chunks of at most ``span``
    ids: ``text``, ``institution``, ``chunk``, ``part``, ``first_id``, ``last_id``,
    ``n_ids``, ``clients``. Integer ids are cut by value (:func:`.idlists.id_chunks`), ids of any
    other type by position in their order (:func:`.idlists.ranked_id_chunks`, an action)."""
    r = reduced if keep_empty else reduced.where(F.col("text") != F.lit(""))
    keys = ["text", "institution"]
    if isinstance(reduced.schema["user_id"].dataType, T.IntegralType):
        return id_chunks(r, keys, "user_id", span, "clients", distinct=True)
    return ranked_id_chunks(r, keys, "user_id", span, "clients")


def client_report(lines: DataFrame, cols: LineColumns = DEFAULT_COLUMNS, span: int = DEFAULT_ID_SPAN,
                  materialize: bool = True) -> tuple[DataFrame, DataFrame]:
    """Profile and client lists from one scan: the reduced frame is written
    to the shared folder once (an action) and both are read from it."""
    reduced = client_lines(lines, cols)
    if materialize:
        reduced = _materialize(reduced, "client-lines")
    return profile_from_client_lines(reduced), client_lists(reduced, span)
