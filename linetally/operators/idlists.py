"""Id lists per group (A7 for row ids, the client list of A17), as a
relation of bounded chunks.

The original kept, for each text, all its row ids joined by ``|`` in one
string. For a frequent text that is one unbounded cell, built in one task.
Here the list is cut by id value: chunk ``c`` of a group holds the ids in
``[c * span, (c + 1) * span)``, ascending, joined by ``|``, in parts of at
most ``span`` entries. Concatenating a group's cells in (chunk, part) order
(with ``|`` between them) gives the original string exactly. No cell and no
aggregation buffer grows with the data, and a frequent text is spread over
many tasks (one per id range) instead of one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import DEFAULT_ID_SPAN, ID_SEPARATOR, LineColumns
from ..session import materialize
from .profile import DEFAULT_COLUMNS, prepared_lines


def chunk_of(id_col: Column, span: int) -> Column:
    """Floor division of an id by ``span``, exact for every bigint including
    negative ids: the numerator is made an exact multiple of ``span`` first,
    then divided with Spark's integral ``div``."""
    s = F.lit(int(span)).cast(T.LongType())
    return F.call_function("div", id_col - F.pmod(id_col, s), s)


def id_chunks(
    df: DataFrame,
    keys: Sequence[str],
    id_col: str,
    span: int = DEFAULT_ID_SPAN,
    out_col: str = "row_ids",
    distinct: bool = False,
) -> DataFrame:
    """Group ``df`` by ``keys`` and id range; one row per (group, chunk, part).

    Columns: ``*keys``, ``chunk`` (id range), ``part`` (piece of that range),
    ``first_id``, ``last_id``, ``n_ids`` (entries in the cell, repeats
    included) and ``out_col`` (the ids ascending, joined by ``|``; an id that
    occurs m times appears m times). ``distinct=True`` lists each id once.

    Every cell holds at most ``span`` entries, even when one id repeats in a
    large share of the rows: occurrences are first counted per (group, id),
    a window over (group, id range), which never holds more than ``span``
    distinct ids, gives each id its start position in the range, and the
    range is cut into parts of ``span`` positions. Parts that several ids share, or that
    an id fills only in part, are put together by group and range, at most two for an
    id. A part that one id fills whole needs no grouping: these are numbered in steps of :data:`FAN` and dealt to tasks by part,
    so neither an array nor a task grows with the repeats of an id. Concatenating a
    group's cells in (chunk, part) order gives the full list.
    """
    if span < 1:
        raise ValueError("span must be >= 1")
    ident = F.col(id_col).cast(T.LongType())
    base = df.select(*keys, ident.alias("_id")).where(F.col("_id").isNotNull())
    occ = base.groupBy(*keys, "_id").agg(F.count(F.lit(1)).alias("_m"))
    return cells_of(occ.withColumn("_m", F.lit(1).cast(T.LongType())) if distinct else occ, keys, span, out_col)


def cells_of(occ: DataFrame, keys: Sequence[str], span: int, out_col: str) -> DataFrame:
    """The cells of :func:`id_chunks` from one row for each group and id (``_id``) with the number of its occurrences (``_m``)."""
    occ = occ.withColumn("chunk", chunk_of(F.col("_id"), span))
    in_range = Window.partitionBy(*keys, "chunk").orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    s = F.lit(int(span)).cast(T.LongType())
    start, end = F.col("_start"), F.col("_start") + F.col("_m")
    placed = occ.withColumn("_start", F.coalesce(F.sum("_m").over(in_range), F.lit(0).cast(T.LongType())))
    # parts from the first to before the second hold this id alone
    placed = placed.withColumns({"_whole": F.call_function("div", start + s - 1, s), "_until": F.call_function("div", end, s)})
    ends = F.array_distinct(F.array(F.call_function("div", start, s), F.call_function("div", end - 1, s)))
    shared = placed.withColumn("part", F.explode(F.filter(ends, lambda p: (p < F.col("_whole")) | (p >= F.col("_until")))))
    reps = F.least(end, (F.col("part") + 1) * s) - F.greatest(start, F.col("part") * s)
    cells = shared.withColumn("_reps", reps).groupBy(*keys, "chunk", "part").agg(
        F.min("_id").alias("first_id"),
        F.max("_id").alias("last_id"),
        F.sum("_reps").alias("n_ids"),
        F.array_sort(F.collect_list(F.struct("_id", "_reps"))).alias("_runs"),
    )
    listed = F.flatten(F.transform("_runs", lambda r: F.array_repeat(r["_id"].cast(T.StringType()), r["_reps"].cast(T.IntegerType()))))
    cells = cells.select(
        *keys, "chunk", "part", "first_id", "last_id",
        F.col("n_ids").cast(T.LongType()).alias("n_ids"),
        F.array_join(listed, ID_SEPARATOR).alias(out_col),
    )
    return cells.unionByName(_filled_parts(placed, keys, span, out_col))


#: Numbers made at a time from one row, so that no array grows with the data.
FAN = 1024


def _filled_parts(placed: DataFrame, keys: Sequence[str], span: int, out_col: str) -> DataFrame:
    """Cells of the parts that one id fills, from its row: numbered in three steps and dealt to all tasks, first by block of parts, then by part."""
    tasks = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def numbers(n):
        return F.explode(F.sequence(F.lit(0).cast(T.LongType()), n - 1))

    def blocks(n, size):
        return F.call_function("div", n + size - 1, F.lit(size).cast(T.LongType()))

    rows = placed.where(F.col("_until") > F.col("_whole")).select(*keys, "chunk", "_id", F.col("_whole").alias("_from"), (F.col("_until") - F.col("_whole")).alias("_n"))
    for size in (FAN * FAN, FAN):
        rows = rows.withColumn("_b", numbers(blocks(F.col("_n"), size))).select(
            *keys, "chunk", "_id", (F.col("_from") + F.col("_b") * size).alias("_from"),
            F.least(F.lit(size).cast(T.LongType()), F.col("_n") - F.col("_b") * size).alias("_n"))
    # few rows that become much text: a number of tasks of our own, as AQE would merge them by their present size
    rows = rows.repartition(tasks, *keys, "chunk", "_from").withColumn("_b", numbers(F.col("_n")))
    rows = rows.select(*keys, "chunk", (F.col("_from") + F.col("_b")).alias("part"), "_id").repartition(tasks, *keys, "chunk", "part")
    text = F.array_join(F.array_repeat(F.col("_id").cast(T.StringType()), span), ID_SEPARATOR)
    return rows.select(*keys, "chunk", "part", F.col("_id").alias("first_id"), F.col("_id").alias("last_id"),
                       F.lit(int(span)).cast(T.LongType()).alias("n_ids"), text.alias(out_col))


def ranked_id_chunks(df: DataFrame, keys: Sequence[str], id_col: str, span: int = DEFAULT_ID_SPAN, out_col: str = "clients") -> DataFrame:
    """The different ids of each group in chunks of ``span`` by *position*, for ids of any type that can be sorted
    (strings, say, which no range of numbers can cut). Columns as of :func:`id_chunks`; ``part`` is 0.

    The (group, id) pairs are range-sorted and written, so a group with a third of the ids is spread over tasks; counts for each range and
    group give the position at which the group goes on in a range. Actions: that sort and its write."""
    if span < 1:
        raise ValueError("span must be >= 1")
    by = [*keys, "_id"]
    pairs = df.select(*keys, F.col(id_col).alias("_id")).where(F.col("_id").isNotNull()).distinct()
    pairs = pairs.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    pairs = materialize(pairs, "ranked-ids").withColumn("_part", F.shiftright("_at", 33))
    counts = pairs.groupBy("_part", *keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    # one row a range and group; null is a group key like any other
    shifts = counts.select(F.col("_part").alias("_p"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                           (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    same = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    placed = pairs.join(shifts, same).select(*by, chunk_of(F.col("_at") + F.col("_shift"), span).alias("chunk"))
    cells = placed.groupBy(*keys, "chunk").agg(F.array_sort(F.collect_list("_id")).alias("_ids"))
    text = F.array_join(F.transform("_ids", lambda x: x.cast(T.StringType())), ID_SEPARATOR)
    return cells.select(*keys, "chunk", F.lit(0).cast(T.LongType()).alias("part"), F.element_at("_ids", 1).alias("first_id"),
                        F.element_at("_ids", -1).alias("last_id"), F.size("_ids").cast(T.LongType()).alias("n_ids"), text.alias(out_col))


def text_id_chunks(
    lines: DataFrame,
    cols: LineColumns = DEFAULT_COLUMNS,
    span: int = DEFAULT_ID_SPAN,
    keep_empty: bool = False,
    strict: bool = True,
) -> DataFrame:
    """Row ids per cleaned text (A7), over the gated lines, as chunks of
    :func:`id_chunks`. The empty text is left out, as in the profile."""
    p = prepared_lines(lines, cols, strict).select("text", "row_id")
    if not keep_empty:
        p = p.where(F.col("text") != F.lit(""))
    return id_chunks(p, ["text"], "row_id", span, "row_ids")

