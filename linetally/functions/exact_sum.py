"""Exact sums of doubles, whatever the order of rows and partitions.

A double is cut into five digits of 27 bits, signed integers, at fixed binary
positions: digit ``i`` of a number with key ``k`` counts units of
``2^(27 (k - i))``. For zero and for magnitudes from 2^-29 to 2^54 (about 2e-9 to 1.8e16) the key is
1, so amounts of one group share it; a number outside has the key of its own
magnitude. Sums of digits by key are sums of integers: a hash aggregate
with numeric buffers, the same in any order. At the end the digits of all keys
are carried into one another and the exact total is rounded once, to the nearest double
(ties to even).

Every step is an expression of built-in functions. A digit has 27 bits and a
sum 63, so 2^36 rows of a group can be added at a time; more fail with an overflow error (in
ANSI mode) and need a finer grouping first. ``totals`` of a grouping can be added
up again by the carried digits that :func:`with_total` gives.

:func:`windowed`, :func:`window_sums` and :func:`with_window_total` do the same with eight digits at fixed positions and no key, for
amounts: zero and magnitudes from 2^-56 to 2^108 (about 1.4e-17 to 3e32); others are an error. Such sums need
no grouping beside the caller's own, so they fit a stream as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 27
DIGITS = 5
_MASK = (1 << BITS) - 1
_UNIT = float(1 << BITS)
_LOW, _HIGH = 2.0**-29, 2.0**54
#: Positions above the highest digit that carries may reach.
_ROOM = 3

PAIR = "array<struct<p:int,d:bigint>>"


def _scaled(x: Column, exponent: Column) -> Column:
    """``x * 2^exponent``, exact: in two steps, as the power alone may leave the range of doubles."""
    half = F.floor(exponent / 2)
    return x * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), exponent - half)


def with_digits(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """``df`` with key and digits of ``column``. Each step is a column of its own, so that none is computed twice."""
    size = F.abs(F.col(column))
    usual = (size == 0) | ((size >= _LOW) & (size < _HIGH))
    # the logarithm may be off by a hair at a power of two: the last digit has the two bits that takes
    key = F.when(F.col(column).isNotNull(), F.when(usual, F.lit(1)).otherwise(F.floor(F.log2(size) / BITS).cast("int")))
    out = df.withColumn(f"{prefix}k", key)
    scaled = F.when(F.col(f"{prefix}k") == 1, size * F.lit(1 / _UNIT)).otherwise(_scaled(size, F.col(f"{prefix}k") * -BITS))
    return _digits(out, scaled, column, prefix, DIGITS)


def _digits(df: DataFrame, scaled: Column, column: str, prefix: str, count: int) -> DataFrame:
    """Digits of 27 bits of ``scaled``, the first one below 2^28: products with powers of two and remainders of doubles are exact."""
    sign = F.when(F.col(column) < 0, F.lit(-1)).otherwise(F.lit(1))
    out = df.withColumn("_scaled", scaled)
    digits = {f"{prefix}0": F.floor("_scaled") * sign}
    for i in range(1, count):
        digits[f"{prefix}{i}"] = F.floor((F.col("_scaled") * 2.0 ** (BITS * i)) % _UNIT) * sign
    return out.withColumns(digits).drop("_scaled")


def digit_names(prefix: str, count: int = DIGITS) -> list[str]:
    return [f"{prefix}{i}" for i in range(count)]


def sums(prefix: str, where: Column | None = None, out: str | None = None, count: int = DIGITS) -> list[Column]:
    """Aggregates: the sums of each digit (of rows ``where``), named like the digits or by the prefix ``out``."""
    def value(c: str) -> Column:
        return F.col(c) if where is None else F.when(where, F.col(c)).otherwise(F.lit(0))

    return [F.sum(value(c)).alias(c if out is None else f"{out}{i}") for i, c in enumerate(digit_names(prefix, count))]


def pairs(key: str, prefix: str) -> Column:
    """Aggregate: the digits of all rows of a group (one row a key) as pairs (position, digit)."""
    each = F.struct(F.col(key).alias("k"), F.array(*[F.col(c) for c in digit_names(prefix)]).alias("s"))
    listed = F.transform(F.collect_list(each), lambda e: F.transform(
        e["s"], lambda d, i: F.struct((e["k"] - i).cast("int").alias("p"), d.cast("bigint").alias("d"))))
    return F.flatten(listed).cast(PAIR)


def _carry(dense: Column) -> Column:
    """Digits of 27 bits from any integers (lowest position first), and what is carried out at the top: 0, or -1 for a negative number."""
    start = F.struct(F.lit(0).cast("bigint").alias("c"), F.array().cast("array<bigint>").alias("d"))

    def step(acc: Column, x: Column) -> Column:
        t = acc["c"] + x
        return F.struct(F.shiftright(t, BITS).alias("c"), F.concat(acc["d"], F.array(t.bitwiseAND(F.lit(_MASK).cast("bigint")))).alias("d"))

    return F.aggregate(dense, start, step)


def with_total(df: DataFrame, pair_column: str, total: str, exact: str | None = None) -> DataFrame:
    """``df`` with ``total``, the double nearest to the exact sum that the pairs stand for (no pairs: 0), and, if wanted, ``exact``:
    the same number as carried pairs, to be added to others."""
    p = F.transform(F.col(pair_column), lambda x: x["p"])
    low, high = F.coalesce(F.array_min(p), F.lit(0)), F.coalesce(F.array_max(p), F.lit(0)) + _ROOM
    out = df.withColumns({"_low": low, "_high": high})
    # the pairs in an array of all positions
    zeros = F.transform(F.sequence("_low", "_high"), lambda i: F.struct(i.alias("p"), F.lit(0).cast("bigint").alias("d")))
    out = out.withColumn("_all", F.concat(F.col(pair_column), zeros).cast(PAIR))
    spots = F.transform(F.sequence("_low", "_high"), lambda i: F.aggregate(
        F.col("_all"), F.lit(0).cast("bigint"), lambda acc, x: acc + F.when(x["p"] == i, x["d"]).otherwise(F.lit(0).cast("bigint"))))
    out = _rounded(out, {total: (spots, F.col("_high"), exact)}).drop("_all")
    if exact is not None:
        signed = F.transform(exact, lambda d, i: F.struct((F.col("_low") + i).cast("int").alias("p"), d.alias("d")))
        out = out.withColumn(exact, F.filter(signed, lambda x: x["d"] != 0).cast(PAIR))
    return out.drop("_low", "_high")


def _rounded(df: DataFrame, totals: dict[str, tuple[Column, Column, str | None]]) -> DataFrame:
    """For each total its double, from (integers lowest position first, highest position, name of the carried digits or None).
    Every step is a projection of its own, so that nothing is computed twice."""
    n = {out: f"_{k}" for k, out in enumerate(totals)}
    step = df.withColumns({f"_dense{n[out]}": dense for out, (dense, _, _) in totals.items()})
    step = step.withColumns({f"_carried{k}": _carry(F.col(f"_dense{k}")) for k in n.values()})
    step = step.withColumns({f"_digits{k}": F.when(F.col(f"_carried{k}.c") < 0, _carry(F.transform(f"_dense{k}", lambda d: -d))["d"])
                             .otherwise(F.col(f"_carried{k}.d")) for k in n.values()})
    made = {f"_top{n[out]}": F.aggregate(F.reverse(f"_digits{n[out]}"), _top_start(high), _top_step) for out, (_, high, _) in totals.items()}
    for out, (_, _, exact) in totals.items():
        if exact is not None:
            minus = F.col(f"_carried{n[out]}.c") < 0
            made[exact] = F.when(minus, F.transform(f"_digits{n[out]}", lambda d: -d)).otherwise(F.col(f"_digits{n[out]}"))
    step = step.withColumns(made)
    step = step.withColumns({out: _nearest(F.col(f"_top{k}"), F.col(f"_carried{k}.c") < 0) for out, k in n.items()})
    return step.drop(*[f"_{name}{k}" for name in ("dense", "carried", "digits", "top") for k in n.values()])


def _nearest(top: Column, minus: Column) -> Column:
    """The double nearest to a number from its first four digits (at position ``p``) and whether more follow."""
    lead, tail = top["v0"] * (1 << BITS) + top["v1"], top["v2"] * (1 << BITS) + top["v3"]
    # 62 leading bits, the last one set if anything follows; long to double rounds to nearest, ties to even
    shift = F.lit(62) - F.length(F.bin(lead))
    below = F.lit(2 * BITS) - shift
    kept = F.call_function("shiftleft", lead, shift) + F.call_function("shiftright", tail, below)
    lost = (F.pmod(tail, F.call_function("shiftleft", F.lit(1).cast("bigint"), below)) != 0) | top["more"]
    whole = kept.bitwiseOR(F.when(lost, F.lit(1)).otherwise(F.lit(0)).cast("bigint")).cast("double")
    value = _scaled(whole, (top["p"] - 1) * BITS - shift)
    return F.when(top["n"] == 0, F.lit(0.0)).when(minus, -value).otherwise(value)


# ---------------------------------------------------------------------------
# A window of fixed positions
# ---------------------------------------------------------------------------

WINDOW = 8
_WINDOW_TOP = 3
_WINDOW_LOW, _WINDOW_HIGH = 2.0**-56, 2.0**108
#: Positions of a carried total of the window, lowest first.
TOTAL = WINDOW + _ROOM


def windowed(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """``df`` with the digits ``<prefix>0`` .. ``<prefix>7`` of a column of finite doubles; a magnitude outside the window fails the job."""
    size = F.abs(F.col(column))
    outside = (size != 0) & ((size < _WINDOW_LOW) | (size >= _WINDOW_HIGH))
    error = F.raise_error(F.lit("amount outside the range of exact sums, 2^-56 to 2^108")).cast("double")
    return _digits(df, F.when(outside, error).otherwise(size * F.lit(2.0 ** (-BITS * _WINDOW_TOP))), column, prefix, WINDOW)


def window_sums(prefix: str, where: Column | None = None, out: str | None = None) -> list[Column]:
    """Aggregates: the sums of the window's digits."""
    return sums(prefix, where, out, WINDOW)


def with_window_total(df: DataFrame, prefix: str, total: str, exact: str | None = None) -> DataFrame:
    """:func:`with_window_totals` of one sum."""
    return with_window_totals(df, {prefix: (total, exact)})


def with_window_totals(df: DataFrame, wanted: dict[str, tuple[str, str | None]]) -> DataFrame:
    """For each prefix (total, exact): ``total``, the double nearest to the exact sum in the columns of :func:`window_sums`, in place of
    these, and, if wanted, ``exact``: the same number as an array of TOTAL carried digits, to be added to others position by position."""
    top = F.lit(_WINDOW_TOP + _ROOM)
    totals = {total: (F.array(*[_long(c) for c in reversed(digit_names(prefix, WINDOW))], *[_zero()] * _ROOM), top, exact)
              for prefix, (total, exact) in wanted.items()}
    return _rounded(df, totals).drop(*[c for prefix in wanted for c in digit_names(prefix, WINDOW)])


def with_totals_of_totals(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """For each prefix its total, from the columns of :func:`total_sums` and in place of these."""
    top = F.lit(_WINDOW_TOP + 2 * _ROOM)
    totals = {total: (F.array(*[_long(c) for c in digit_names(prefix, TOTAL)], *[_zero()] * _ROOM), top, None)
              for prefix, total in wanted.items()}
    return _rounded(df, totals).drop(*[c for prefix in wanted for c in digit_names(prefix, TOTAL)])


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def _long(c: str) -> Column:
    return F.coalesce(F.col(c).cast("bigint"), _zero())


def total_sums(exact: str, prefix: str, minus: str | None = None) -> list[Column]:
    """Aggregates: sums by position of a column of carried digits (less another such column)."""
    at = lambda i: F.get(exact, F.lit(i)) if minus is None else F.get(exact, F.lit(i)) - F.get(minus, F.lit(i))
    return [F.sum(at(i)).alias(f"{prefix}{i}") for i in range(TOTAL)]


def _top_start(high: Column) -> Column:
    zero = F.lit(0).cast("bigint")
    return F.struct(F.lit(0).alias("n"), high.alias("p"), zero.alias("v0"), zero.alias("v1"), zero.alias("v2"), zero.alias("v3"), F.lit(False).alias("more"))


def _top_step(acc: Column, d: Column) -> Column:
    """From the highest position down: the first four digits from the first that isn't zero (at ``p``), and whether more follow."""
    n = acc["n"]
    started = (n > 0) | (d != 0)
    put = [F.when((n == i) & started, d).otherwise(acc[f"v{i}"]).alias(f"v{i}") for i in range(4)]
    return F.struct((n + started.cast("int")).alias("n"), F.when(started, acc["p"]).otherwise(acc["p"] - 1).alias("p"), *put,
                    (acc["more"] | ((n >= 4) & (d != 0))).alias("more"))


def sum_doubles(df: DataFrame, keys: list[str], column: str, out: str) -> DataFrame:
    """Exact sum of a column of finite doubles by ``keys`` (none: one row), nulls left out, each sum rounded once. The rows are
    aggregated before they are shuffled; a group without values sums to 0."""
    by_key = with_digits(df.select(*keys, F.col(column).alias("_x")), "_x", "_x").groupBy(*keys, "_xk").agg(*sums("_x"))
    known = F.col("_xk").isNotNull()
    listed = by_key.select(*keys, F.when(known, F.col("_xk")).otherwise(F.lit(1)).alias("_xk"),
                           *[F.when(known, F.col(c)).otherwise(F.lit(0)).alias(c) for c in digit_names("_x")])
    return with_total(listed.groupBy(*keys).agg(pairs("_xk", "_x").alias("_pairs")), "_pairs", out).select(*keys, out)
