"""Whether ids are unique, without shuffling them where the table's order shows it.

Tables are mostly written in the order of their ids, so each split of a scan holds a
stretch of them. The ids of a split are sorted where they are and run through
once: that gives the split's least and greatest id and whether one occurs twice in it. If no
stretch overlaps another, ids of different splits differ, and the question is
answered by one row a split. Only ids within stretches that do overlap are suspects, and only these
are counted across splits. Unordered ids (random strings, say) are all
suspects, and then this costs what counting them all does.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Overlaps that become one condition; more are joined into one that spans them.
MAX_OVERLAPS = 200


def stretches(df: DataFrame, id_col: str) -> DataFrame:
    """For each split with ids: ``low``, ``high`` and ``again``, whether an id occurs twice in it. No shuffle; ids are sorted within their split
    (by Spark, which spills) and read batch by batch."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = last = None
        again = False
        for batch in batches:
            ids = batch.column(0)
            if not len(ids):
                continue
            again = again or ids[0] == last or bool(len(ids) > 1 and pc.any(pc.equal(ids[1:], ids[:-1])).as_py())
            low, last = (ids[0] if low is None else low), ids[-1]
        if low is not None:
            yield pa.RecordBatch.from_arrays([pa.array([low.as_py()], low.type), pa.array([last.as_py()], low.type), pa.array([again])],
                                             names=["low", "high", "again"])

    ids = df.select(F.col(f"`{id_col}`").alias("id")).where(F.col("id").isNotNull()).sortWithinPartitions("id")
    return ids.mapInArrow(run, f"low {kind}, high {kind}, again boolean")


def overlaps(spans: list[tuple]) -> list[tuple]:
    """The stretches (low, high), both ends included, that two or more of ``spans`` share, as disjoint ones in order."""
    out, reach = [], None
    for low, high in sorted(spans):
        if reach is not None and low <= reach:
            end = min(high, reach)
            if out and low <= out[-1][1]:
                out[-1] = (out[-1][0], max(out[-1][1], end))
            else:
                out.append((low, end))
        reach = high if reach is None else max(reach, high)
    return out


def _within(shared: list[tuple], c: Column) -> Column:
    if len(shared) > MAX_OVERLAPS:
        shared = [(shared[0][0], shared[-1][1])]
    cond = F.lit(False)
    for low, high in shared:
        cond = cond | c.between(F.lit(low), F.lit(high))
    return cond


def ids_unique(df: DataFrame, id_col: str) -> bool:
    """Whether no id occurs twice (null counts as an id). Actions: one pass over the id column, of which the driver gets two ids and a flag
    for each split; and, if stretches overlap, a count of the ids within the overlaps."""
    if df.where(F.col(f"`{id_col}`").isNull()).limit(2).count() > 1:
        return False
    found = stretches(df, id_col).collect()
    if any(r["again"] for r in found):
        return False
    shared = overlaps([(r["low"], r["high"]) for r in found])
    if not shared:
        return True
    ident = F.col(f"`{id_col}`")
    suspects = df.where(_within(shared, ident)).groupBy(ident.alias("id")).agg(F.count(F.lit(1)).alias("_n"))
    return suspects.where(F.col("_n") > 1).isEmpty()
