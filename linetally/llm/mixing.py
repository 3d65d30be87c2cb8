"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, each queue up to
``max_repeats`` times over. A document's virtual finish time is the number
of words its source has sent when it ends, divided by the source's weight; the
mix takes the documents in the order of these times until its budget is
used up. Sources thus advance in proportion to their weights, and one that
has run out leaves its share to the others, which is exactly how the
targets are defined (:func:`source_targets`).

How it is distributed. The shuffled order of a source is cut into buckets
by the leading digits of the document's hash. A running sum within (source,
bucket) plus the sums of the buckets before gives each finish time, so a
source with a third of all rows is spread over all buckets. The times of all
sources are then range-sorted and written once with their partition
number; partition sums tell in which partition the budget ends, and only
that partition is summed row by row to find the last time taken. A document
is taken as often as its finish times are not after that one; in the order of
its source these are the first documents, so one place for each source and repeat
says which. Texts and other columns are written once and compared with
these places where they lie; only ids, hashes and sizes are shuffled.

Results for odd input: a null source is a source of its own (the last); null
or empty texts have size 0, take no room and are never taken; identical rows
are told apart only by the order they are written in, which changes no sum; equal finish times
are ordered by source, then by position in the source; an empty table gives an
empty result. Reruns agree: order, sums and cut follow from the rows alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize
from .common import carried, whole_text, words

WEIGHTS = (5, 2, 1)
#: Budget of the mix as a fraction of all words, exact: 3 / 2.
BUDGET = (3, 2)
MAX_REPEATS = 2
#: Leading hexadecimal digits of the hash that name a bucket: 4096 of them.
BUCKET_DIGITS = 3

MADE = ("size", "source_size", "target", "taken")


def source_key(source: Column) -> Column:
    """A key that is never null and sorts by code point, null last."""
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, budget: tuple[int, int] = BUDGET,
                   max_repeats: int = MAX_REPEATS) -> DataFrame:
    """From one row per source (``_source`` as in :func:`source_key`,
    ``source_size``): ``_rank``, ``weight`` (the given ones, repeating) and
    ``target``. All sources fill at the rate of their weights until the budget is
    used; a full one (``max_repeats`` times its size) drops out. In the order
    of the level at which sources fill up, the level after the first k is what is left of
    the budget over the weights left; it rises as long as full sources drop out
    and falls after, so the final level is the greatest of them."""
    # one row per source: a small frame by the meaning of the column
    by_name = W.orderBy("_source")
    ranked = sizes.withColumn("_rank", F.row_number().over(by_name))
    pick = F.array(*[F.lit(int(w)) for w in weights])
    ranked = ranked.withColumn("weight", F.get(pick, (F.col("_rank") - 1) % len(weights)).cast("double"))
    ranked = ranked.withColumn("_cap", F.col("source_size") * max_repeats)
    by_fill = W.orderBy(F.col("_cap") / F.col("weight"), "_rank")
    before, rest, whole = by_fill.rowsBetween(W.unboundedPreceding, -1), by_fill.rowsBetween(0, W.unboundedFollowing), W.partitionBy()
    left = F.sum("source_size").over(whole) * F.lit(float(budget[0])) / F.lit(float(budget[1])) - F.coalesce(
        F.sum("_cap").over(before), F.lit(0)).cast("double")
    ranked = ranked.withColumn("_level", left / F.sum("weight").over(rest))
    level = F.max("_level").over(whole)
    return ranked.withColumn("target", F.least(F.col("_cap").cast("double"), F.col("weight") * level)).select(
        "_source", "_rank", "weight", "source_size", "target")


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text: str = "text",
        columns: Sequence[str] | None = None, weights: Sequence[int] = WEIGHTS, budget: tuple[int, int] = BUDGET,
        max_repeats: int = MAX_REPEATS, seed: str = "mix") -> DataFrame:
    """``columns`` of ``docs`` (default all) with ``size`` (words),
    ``source_size``, ``target`` (both of the source) and ``taken`` (words the mix
    takes from the document, repeats counted); input columns of these names are
    replaced. Actions: writes the sized rows, the times, their order and the places reached."""
    keep = carried(docs, MADE, columns)
    kept = [F.col(f"`{c}`") for c in keep]
    ident = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    # the row number, once written, tells rows of equal id and size apart
    rows = materialize(docs.select(
        *kept, source_key(F.col(f"`{source_col}`")).alias("_source"), ident.alias("_id"),
        F.size(words(whole_text(text))).cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), ident)).alias("_hash"), F.monotonically_increasing_id().alias("_row")), "mix-sized")
    sized = rows.select("_source", *PLACE, F.substring("_hash", 1, BUCKET_DIGITS).alias("_bucket"))
    # one row per (source, bucket): at most 4096 for each source
    buckets = materialize(sized.groupBy("_source", "_bucket").agg(F.sum("size").alias("_n")), "mix-buckets")
    sizes = buckets.groupBy("_source").agg(F.sum("_n").alias("source_size"))
    targets = materialize(source_targets(sizes, weights, budget, max_repeats), "mix-targets")
    before = F.sum("_n").over(W.partitionBy("_source").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1))
    offsets = buckets.withColumn("_before", F.coalesce(before, F.lit(0))).drop("_n").join(targets, "_source")
    in_bucket = W.partitionBy("_source", "_bucket").orderBy(*PLACE)
    run = sized.withColumn("_run", F.sum("size").over(in_bucket.rowsBetween(W.unboundedPreceding, 0)))
    timed = run.join(offsets, ["_source", "_bucket"])
    timed = materialize(timed.select("_source", *PLACE, "source_size", "_rank", "weight",
                                     (F.col("_before") + F.col("_run")).alias("_at")), "mix-timed")
    ends = [F.col("_at") + F.col("source_size") * k for k in range(max_repeats)]
    items = timed.where(F.col("size") > 0).select("_rank", "size", "weight", F.explode(F.array(*ends)).alias("_at"))
    items = items.withColumn("_time", F.col("_at") / F.col("weight"))
    ranged = items.select(*ORDER, "size").repartitionByRange(*ORDER).withColumn("_part", F.spark_partition_id())
    last = _last_taken(materialize(ranged, "mix-order"), budget, max_repeats)
    reached = targets.select("_source", "source_size", "target")
    count = F.lit(0)
    if last is not None:
        limit = F.struct(F.lit(last["_time"]).alias("_time"), F.lit(last["_rank"]).alias("_rank"),
                         F.lit(last["_at"]).cast("bigint").alias("_at"))
        place, bounds = F.struct(*PLACE), []
        for k, end in enumerate(ends):
            item = F.struct((end / F.col("weight")).alias("_time"), F.col("_rank"), end.alias("_at"))
            bounds.append(F.max(F.when(item <= limit, place)).alias(f"_last_{k}"))
            count = count + F.when(place <= F.col(f"_last_{k}"), 1).otherwise(0)
        reached = reached.join(timed.groupBy("_source").agg(*bounds), "_source", "left")
    # one row per source, written, so that its size is known and it goes to the rows
    reached = materialize(reached, "mix-reached")
    return rows.join(reached, "_source").withColumn("taken", (F.col("size") * count).cast("long")).select(
        *kept, "size", "source_size", "target", "taken")


#: Order of the rows of a source, no two alike.
PLACE = ("_hash", "_id", "size", "_row")
#: Order of the mix: virtual finish time, then source, then position.
ORDER = ("_time", "_rank", "_at")


def _last_taken(ranged: DataFrame, budget: tuple[int, int], max_repeats: int) -> Row | None:
    """The last item that fits the budget in the global order. The driver gets
    one sum for each partition of the order, then one row."""
    sums = sorted(map(tuple, ranged.groupBy("_part").agg(F.sum("size")).collect()))
    left = sum(n for _, n in sums) // max_repeats * budget[0] // budget[1]
    taken_parts, at = [], None
    for part, n in sums:
        if n > left:
            at = part
            break
        left -= n
        taken_parts.append(part)
    run = F.sum("size").over(W.partitionBy("_part").orderBy(*ORDER).rowsBetween(W.unboundedPreceding, 0))
    fits = ranged.where(F.col("_part") == (-1 if at is None else at)).withColumn("_sum", run).where(F.col("_sum") <= left)
    for part in (fits, ranged.where(F.col("_part") == (taken_parts[-1] if taken_parts else -1))):
        row = part.agg(F.max(F.struct(*ORDER)).alias("m")).select("m.*").first()
        if row["_at"] is not None:
            return row
    return None
