"""The per-text measures of the profile over a Structured Streaming source.

Lines that arrive as a stream (files landing in a folder, a message bus)
are gated, cleaned and aggregated by text exactly as in the batch
:func:`linetally.operators.profile.text_groups`; the state store keeps one
row per text. Streaming allows only one aggregation per query, so the
representative row is kept as ``min(struct(row_id, category, quartil))`` in
that single aggregation instead of the batch plan's two stages. The output
has the columns of ``text_groups``, so the batch
:func:`profile_from_groups` / :func:`totals_from_groups` apply to any
snapshot of it (for example inside ``foreachBatch`` in complete mode).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.buckets import is_dia, is_madrugada, is_noite, is_tarde
from ..operators.profile import DEFAULT_COLUMNS, amount_sums, finished_groups, is_exact, prepared_lines, summable
from ..schema import UNDEFINED_CATEGORY, LineColumns
from ..session import scratch_path


def streaming_text_groups(
    lines: DataFrame,
    cols: LineColumns = DEFAULT_COLUMNS,
    strict: bool = True,
    sentinel: str = UNDEFINED_CATEGORY,
) -> DataFrame:
    """Running per-text measures of a streaming (or batch) lines frame."""
    exact = is_exact(cols)
    p = summable(prepared_lines(lines, cols, strict), cols)
    h = F.col("hour")
    undefined = F.col("category") == F.lit(sentinel)
    agg = p.groupBy("text").agg(
        F.count(F.lit(1)).alias("cnt"),
        *amount_sums(exact),
        F.count_if(undefined).alias("undefined_count"),
        *amount_sums(exact, undefined, "undefined_amount"),
        F.min(F.struct(F.col("row_id").alias("first_id"), F.col("category"), F.col("quartil"))).alias("rep"),
        F.count_if(is_madrugada(h)).alias("n_madrugada"),
        F.count_if(is_dia(h)).alias("n_dia"),
        F.count_if(is_tarde(h)).alias("n_tarde"),
        F.count_if(is_noite(h, compat=True)).alias("n_noite_compat"),
        F.count_if(is_noite(h, compat=False)).alias("n_noite_fixed"),
    )
    return finished_groups(agg, exact)


def start_text_groups_stream(
    lines: DataFrame,
    cols: LineColumns = DEFAULT_COLUMNS,
    checkpoint_location: str | None = None,
    query_name: str | None = None,
    foreach_batch: Callable[[DataFrame, int], None] | None = None,
    strict: bool = True,
    sentinel: str = UNDEFINED_CATEGORY,
    snapshot_path: str | None = None,
    output_mode: str = "complete",
    available_now: bool = False,
    processing_time: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start the streaming aggregation.

    With ``snapshot_path`` (complete mode) each micro-batch's result replaces
    a Parquet snapshot at that path, written by the executors; with
    ``foreach_batch`` the result is handed to that function; one of them
    has to be given. The checkpoint defaults to a fresh folder below the shared folder, so the
    query's state survives executor and driver restarts.

    ``state_partitions`` fixes the number of state-store partitions of a
    new query (it is kept in the checkpoint afterwards; AQE does not
    coalesce stateful stages). The session's ``spark.sql.shuffle.partitions``
    is used when it is not given; the query takes its own copy of the
    session settings at start, so the caller's setting is restored at once.
    """
    if snapshot_path is None and foreach_batch is None:
        raise ValueError("give a sink: snapshot_path or foreach_batch")
    groups = streaming_text_groups(lines, cols, strict, sentinel)
    spark = lines.sparkSession
    writer = groups.writeStream.outputMode(output_mode).option(
        "checkpointLocation", checkpoint_location or scratch_path(spark, "stream-checkpoint")
    )
    if snapshot_path is not None:
        if output_mode != "complete":
            raise ValueError("a snapshot needs output_mode='complete'")

        def write_snapshot(batch: DataFrame, epoch: int) -> None:
            batch.write.mode("overwrite").parquet(snapshot_path)

        writer = writer.foreachBatch(write_snapshot)
    else:
        writer = writer.foreachBatch(foreach_batch)
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    if state_partitions is None:
        return writer.start()
    key = "spark.sql.shuffle.partitions"
    previous = spark.conf.get(key)
    spark.conf.set(key, str(int(state_partitions)))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, previous)
