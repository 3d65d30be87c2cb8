"""Text profile: totals (A2-A4, A10), per-text measures (A5, A6, A8, A9),
shares (A11, A12) and the full profile (A18), with the required-columns gate
(P3) and the removal of the empty text (P4).

Plan shape (one scan of the source, two small shuffles):

    scan -> gate -> project(clean, money, bucket, hour)
         -> partial agg (text, category)  -- hash aggregate, numeric buffers
         -> exchange (text, category)     -- map-side combined rows only
         -> final agg (text, category)
         -> exchange (text)               -- one row per (text, category)
         -> merge agg (text)              -- representative row chosen here

Amounts are doubles unless the columns name an exact type. Their sums are
exact and rounded once (:mod:`linetally.functions.exact_sum`), so no result
depends on the order of rows or the number of partitions; totals are summed from the exact group
sums, not from rounded ones.

The representative category is a string, and a string in an aggregation
buffer forces Spark into a sort-based aggregate. Grouping by
``(text, category)`` first keeps that out of the heavy stage: the sort-based
merge only sees one row per (text, category). A hot text is no problem for
either stage, since both aggregate partially before they shuffle.

The grouped frame is small next to the input. :func:`text_profile` writes it
once to the shared folder (:func:`linetally.session.materialize`) and derives
totals and profile from that copy; without it the totals branch would scan
the source a second time, because column pruning makes the two branches
differ and Spark cannot reuse the exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.buckets import (
    hour_of_day,
    is_dia,
    is_madrugada,
    is_noite,
    is_tarde,
    money,
    parse_double,
    percentage_bucket,
    required,
    share,
    to_double,
)
from ..functions import exact_sum
from ..functions.text import clean_text
from ..schema import BUCKET_BOUNDS, UNDEFINED_CATEGORY, LineColumns
from ..session import materialize as _materialize

DEFAULT_COLUMNS = LineColumns()


def gate(lines: DataFrame, cols: LineColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Keep rows whose id, amount, text and category are all non-null (P3).

    Deliberately not ``dropna``: that would also drop NaN amounts.
    """
    return lines.where(
        F.col(cols.row_id).isNotNull()
        & F.col(cols.amount).isNotNull()
        & F.col(cols.text).isNotNull()
        & F.col(cols.category).isNotNull()
    )


def prepared_lines(lines: DataFrame, cols: LineColumns = DEFAULT_COLUMNS, strict: bool = True) -> DataFrame:
    """Gated lines reduced to the columns every measure needs:
    ``text`` (cleaned), ``row_id`` (bigint), ``amount`` (of the amount type),
    ``category``, ``quartil`` (bucket of the category percentage) and
    ``hour``. ``strict`` decides whether a malformed or null percentage and a
    null timestamp fail the job (as in the original), or count as bucket 0
    and in no day part."""
    g = gate(lines, cols)
    return g.select(
        clean_text(F.col(cols.text).cast(T.StringType())).alias("text"),
        F.col(cols.row_id).cast(T.LongType()).alias("row_id"),
        money(cols.amount, cols.amount_type).alias("amount"),
        F.col(cols.category).alias("category"),
        percentage_bucket(parse_double(required(cols.category_pct, strict, "percentage"), strict)).alias("quartil"),
        hour_of_day(required(cols.ts, strict, "timestamp")).alias("hour"),
    )


def text_groups(
    lines: DataFrame,
    cols: LineColumns = DEFAULT_COLUMNS,
    strict: bool = True,
    sentinel: str = UNDEFINED_CATEGORY,
) -> DataFrame:
    """One row per cleaned text, the empty text included (lazy).

    Columns: ``text``, ``cnt``, ``amount``, ``undefined_count``,
    ``undefined_amount``, ``first_id`` (least row id), ``category`` and
    ``quartil`` (of the row with the least id; among rows sharing that id
    the least category, then the least bucket wins), ``n_madrugada``, ``n_dia``, ``n_tarde``,
    ``n_noite_compat``, ``n_noite_fixed``; for doubles also ``amount_exact`` and ``undefined_exact``, the
    sums before rounding (arrays of digits, see :mod:`linetally.functions.exact_sum`).
    """
    p = summable(prepared_lines(lines, cols, strict), cols)
    return merge_categories(p.groupBy("text", "category").agg(*line_measures(is_exact(cols))), sentinel)


DAY_PART_COUNTS = ("n_madrugada", "n_dia", "n_tarde", "n_noite_compat", "n_noite_fixed")
#: Buckets of the category percentage, and the least id met in each: numbers, so that a hash aggregate
#: can find the bucket of the row with the least id.
BUCKETS = range(len(BUCKET_BOUNDS))
_FIRST_IN = tuple(f"first_in_{b}" for b in BUCKETS)
_DIGITS = "_amt"


def is_exact(cols: LineColumns) -> bool:
    """Whether the columns' amounts are doubles, whose sums go by digits (an exact type is summed as it is)."""
    return cols.amount_type == "double"


def summable(rows: DataFrame, cols: LineColumns) -> DataFrame:
    """``rows`` with what :func:`amount_sums` adds up: the digits of ``amount``, if it is a double."""
    return exact_sum.windowed(rows, "amount", _DIGITS) if is_exact(cols) else rows


def amount_sums(exact: bool, where: Column | None = None, out: str = "amount") -> list[Column]:
    """Aggregates of the amounts (of rows ``where``), to be merged or finished as ``out``."""
    if exact:
        return exact_sum.window_sums(_DIGITS, where, None if out == "amount" else f"_{out}")
    amount = F.col("amount") if where is None else F.when(where, F.col("amount")).otherwise(F.lit(0))
    return [F.sum(amount).alias(out)]


def finish_amount(df: DataFrame, exact: bool) -> DataFrame:
    """``df`` with the rounded ``amount`` from :func:`amount_sums`."""
    return exact_sum.with_window_total(df, _DIGITS, "amount") if exact else df


def line_measures(exact: bool) -> list[Column]:
    """Aggregates over prepared lines (:func:`summable`), all with numeric buffers (so a hash
    aggregate with partial aggregation computes them): ``cnt``, the amount,
    ``first_id``, the least id in each bucket and the day-part counts."""
    h = F.col("hour")
    return [
        F.count(F.lit(1)).alias("cnt"),
        *amount_sums(exact),
        F.min("row_id").alias("first_id"),
        *[F.min(F.when(F.col("quartil") == b, F.col("row_id"))).alias(c) for b, c in zip(BUCKETS, _FIRST_IN)],
        F.count_if(is_madrugada(h)).alias("n_madrugada"),
        F.count_if(is_dia(h)).alias("n_dia"),
        F.count_if(is_tarde(h)).alias("n_tarde"),
        F.count_if(is_noite(h, compat=True)).alias("n_noite_compat"),
        F.count_if(is_noite(h, compat=False)).alias("n_noite_fixed"),
    ]


def first_bucket() -> Column:
    """The least bucket among rows with the least id, from the least id in each bucket."""
    return F.coalesce(*[F.when(F.col(c) == F.col("first_id"), F.lit(b)) for b, c in zip(BUCKETS, _FIRST_IN)])


def merge_categories(per_category: DataFrame, sentinel: str = UNDEFINED_CATEGORY) -> DataFrame:
    """From one row per (text, category) of :func:`line_measures` to one row
    per text, choosing the representative row (least id; among rows sharing
    it, the least category, then the least bucket). The only step with a string in an aggregation
    buffer, on the reduced frame."""
    exact = f"{_DIGITS}0" in per_category.columns
    undefined = F.col("category") == F.lit(sentinel)
    merged = per_category.groupBy("text").agg(
        F.sum("cnt").alias("cnt"),
        *amount_sums(exact),
        F.sum(F.when(undefined, F.col("cnt")).otherwise(F.lit(0))).alias("undefined_count"),
        *amount_sums(exact, undefined, "undefined_amount"),
        F.min(F.struct(F.col("first_id"), F.col("category"), first_bucket().alias("quartil"))).alias("rep"),
        *[F.sum(c).alias(c) for c in DAY_PART_COUNTS],
    )
    return finished_groups(merged, exact)


def finished_groups(merged: DataFrame, exact: bool) -> DataFrame:
    """The columns of :func:`text_groups` from the sums and ``rep`` (id, category, quartil of the representative row)."""
    if exact:
        merged = exact_sum.with_window_totals(merged, {_DIGITS: ("amount", "amount_exact"),
                                                       "_undefined_amount": ("undefined_amount", "undefined_exact")})
    return merged.select(
        "text",
        "cnt",
        "amount",
        "undefined_count",
        "undefined_amount",
        F.col("rep.first_id").alias("first_id"),
        F.col("rep.category").alias("category"),
        F.col("rep.quartil").alias("quartil"),
        *DAY_PART_COUNTS,
        *(["amount_exact", "undefined_exact"] if exact else []),
    )


def text_counts(lines: DataFrame, cols: LineColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Count and amount per cleaned text (A5, A6), empty text included.

    The minimal slice of the profile: a single hash aggregate around one
    exchange on the text."""
    g = gate(lines, cols).select(clean_text(F.col(cols.text).cast(T.StringType())).alias("text"), money(cols.amount, cols.amount_type).alias("amount"))
    exact = is_exact(cols)
    counted = summable(g, cols).groupBy("text").agg(F.count(F.lit(1)).alias("count"), *amount_sums(exact))
    return finish_amount(counted, exact).select("text", "count", to_double("amount").alias("amount"))


def _total_columns(groups: DataFrame) -> list[Column]:
    """Aggregates of the amounts over all groups."""
    if "amount_exact" not in groups.columns:
        return [F.sum("amount").alias("total_amount"), F.sum("undefined_amount").alias("undefined_amount")]
    return [*exact_sum.total_sums("amount_exact", "_a"), *exact_sum.total_sums("undefined_exact", "_u"),
            *exact_sum.total_sums("amount_exact", "_c", minus="undefined_exact")]


def _finish_totals(t: DataFrame, groups: DataFrame) -> DataFrame:
    """``total_amount``, ``undefined_amount`` and ``categorised_amount`` (each rounded once, if exact) from :func:`_total_columns`."""
    if "amount_exact" not in groups.columns:
        zero = F.lit(0)
        return t.withColumn("categorised_amount", F.coalesce("total_amount", zero) - F.coalesce("undefined_amount", zero))
    return exact_sum.with_totals_of_totals(t, {"_a": "total_amount", "_u": "undefined_amount", "_c": "categorised_amount"})


def totals_from_groups(groups: DataFrame) -> DataFrame:
    """One row: ``total_count``, ``total_amount``, ``undefined_count``,
    ``undefined_amount``, ``categorised_count``, ``categorised_amount`` and
    ``unique_texts`` (A2, A3, A4, A10). Totals and the number of distinct
    texts include the empty text."""
    t = groups.agg(
        F.coalesce(F.sum("cnt"), F.lit(0)).alias("total_count"),
        F.coalesce(F.sum("undefined_count"), F.lit(0)).alias("undefined_count"),
        F.count(F.lit(1)).alias("unique_texts"),
        *_total_columns(groups),
    )
    zero = F.lit(0)
    return _finish_totals(t, groups).select(
        F.col("total_count").cast(T.LongType()).alias("total_count"),
        to_double(F.coalesce("total_amount", zero)).alias("total_amount"),
        F.col("undefined_count").cast(T.LongType()).alias("undefined_count"),
        to_double(F.coalesce("undefined_amount", zero)).alias("undefined_amount"),
        (F.col("total_count") - F.col("undefined_count")).cast(T.LongType()).alias("categorised_count"),
        to_double("categorised_amount").alias("categorised_amount"),
        F.col("unique_texts").cast(T.LongType()).alias("unique_texts"),
    )


def _round(c: Column, round_to: int | None) -> Column:
    return c if round_to is None else F.round(c, round_to)


def profile_from_groups(
    groups: DataFrame,
    compat: bool = True,
    round_to: int | None = None,
    key: str = "text",
    keep_empty: bool = False,
) -> DataFrame:
    """The 15-column text profile from a grouped frame (A11, A12, A18, P4).

    Shares are fractions of the totals, which include the empty text, so
    they may sum to less than 1 once the empty text is removed.
    ``compat=True`` reproduces the original output: *noite* counts every
    hour outside [12, 18), and ``percentual_madrugada`` repeats the
    ``percentual_dia`` value. ``compat=False`` gives night = hour >= 18 and
    the madrugada share of its own. ``round_to`` rounds the shares half-up
    (the original meant to round to 2 places but never did).

    The row id list is not a column here: for a frequent text it would be
    one unbounded cell. It is a relation of its own,
    :func:`linetally.operators.idlists.text_id_chunks`.
    """
    totals = _finish_totals(groups.agg(F.sum("cnt").alias("tot_cnt"), *_total_columns(groups)), groups).select(
        "tot_cnt", F.col("total_amount").alias("tot_amount"))
    g = groups if keep_empty else groups.where(F.col("text") != F.lit(""))
    # One-row side: the broadcast has a proven size bound.
    j = g.crossJoin(F.broadcast(totals))
    noite = F.col("n_noite_compat") if compat else F.col("n_noite_fixed")
    madrugada_share = share(F.col("n_dia"), F.col("cnt")) if compat else share(F.col("n_madrugada"), F.col("cnt"))
    return j.select(
        F.col("text").alias(key),
        F.col("cnt").alias("count"),
        to_double("amount").alias("amount"),
        F.col("category"),
        _round(share(F.col("cnt"), F.col("tot_cnt")), round_to).alias("percentual_count"),
        _round(share(F.col("amount"), F.col("tot_amount")), round_to).alias("percentual_amount"),
        F.col("quartil").alias("category_percentual_quartil"),
        F.col("n_dia").alias("count_dia"),
        F.col("n_tarde").alias("count_tarde"),
        noite.alias("count_noite"),
        F.col("n_madrugada").alias("count_madrugada"),
        _round(share(F.col("n_dia"), F.col("cnt")), round_to).alias("percentual_dia"),
        _round(share(F.col("n_tarde"), F.col("cnt")), round_to).alias("percentual_tarde"),
        _round(share(noite, F.col("cnt")), round_to).alias("percentual_noite"),
        _round(madrugada_share, round_to).alias("percentual_madrugada"),
    )


def grouped(lines: DataFrame, cols: LineColumns = DEFAULT_COLUMNS, strict: bool = True,
            sentinel: str = UNDEFINED_CATEGORY, materialize: bool = True) -> DataFrame:
    """:func:`text_groups`, written once to the shared folder when
    ``materialize`` (an action) so that several results can be derived from
    it with a single scan of the source."""
    g = text_groups(lines, cols, strict, sentinel)
    return _materialize(g, "text-groups") if materialize else g


def text_profile(
    lines: DataFrame,
    cols: LineColumns = DEFAULT_COLUMNS,
    compat: bool = True,
    strict: bool = True,
    sentinel: str = UNDEFINED_CATEGORY,
    round_to: int | None = None,
    materialize: bool = True,
) -> DataFrame:
    """Text profile of a statement-lines table (A18). See
    :func:`profile_from_groups` for the columns and the two modes."""
    return profile_from_groups(grouped(lines, cols, strict, sentinel, materialize), compat, round_to)


def text_totals(lines: DataFrame, cols: LineColumns = DEFAULT_COLUMNS, strict: bool = True,
                sentinel: str = UNDEFINED_CATEGORY) -> DataFrame:
    """Totals of a statement-lines table (A2-A4, A10), lazily."""
    return totals_from_groups(text_groups(lines, cols, strict, sentinel))
