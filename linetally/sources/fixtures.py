"""Statement lines derived from the test tables.

The test data has no table of categorised statement lines, so one is
derived from ``events`` and ``part``: every event becomes a line whose text
is built from the part it maps to. The same definition, written in SQL,
is in :data:`STATEMENT_LINES_SQL` for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import UNDEFINED_CATEGORY, LineColumns

LINE_COLUMNS = LineColumns()

STATEMENT_LINES_SQL = f"""
SELECT e.event_id AS row_id,
       concat_ws(' ', p.p_name, p.p_type, p.p_brand) AS text,
       e.value AS amount,
       CASE WHEN e.event_type = 'error' THEN '{UNDEFINED_CATEGORY}' ELSE e.event_type END AS category,
       CAST(json_extract_string(e.props, '$.k') AS DOUBLE) AS category_pct,
       e.ts AS ts,
       e.user_id AS user_id,
       p.p_type AS institution
FROM events e
JOIN part p ON e.event_id % (SELECT count(*) FROM part) = p.p_partkey
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lines_from(events: DataFrame, part: DataFrame) -> DataFrame:
    """Statement lines from an ``events`` frame (batch or streaming) and the
    ``part`` table; see :func:`statement_lines`."""
    part = part.select("p_partkey", "p_name", "p_type", "p_brand")
    n_parts = part.select(F.count(F.lit(1))).scalar()
    keyed = events.withColumn("_part_key", F.col("event_id") % n_parts)
    joined = keyed.join(part, keyed["_part_key"] == part["p_partkey"], "inner")
    return joined.select(
        F.col("event_id").alias(LINE_COLUMNS.row_id),
        F.concat_ws(" ", "p_name", "p_type", "p_brand").alias(LINE_COLUMNS.text),
        F.col("value").alias(LINE_COLUMNS.amount),
        F.when(F.col("event_type") == "error", F.lit(UNDEFINED_CATEGORY))
        .otherwise(F.col("event_type"))
        .alias(LINE_COLUMNS.category),
        # the "k" field of the JSON props, as text, then as a number
        F.from_json("props", "k STRING")["k"].cast(T.DoubleType()).alias(LINE_COLUMNS.category_pct),
        F.col("ts").alias(LINE_COLUMNS.ts),
        F.col("user_id").alias(LINE_COLUMNS.user_id),
        F.col("p_type").alias(LINE_COLUMNS.institution),
    )


def statement_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with the columns of :class:`LineColumns` from ``events`` x ``part``.

    The join key is ``event_id % count(part)``; the count is a scalar
    subquery that Spark evaluates once. The join strategy is left to the
    optimizer: ``part`` is broadcast only while its measured size is under
    the broadcast threshold, otherwise the join is a shuffle join on the key.
    """
    return lines_from(table(spark, sf_dir, "events"), table(spark, sf_dir, "part"))


def statement_lines_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines with ``events`` read as a file stream (every Parquet
    file of the events table is a new input file); ``part`` stays static,
    so the join is a stream-static join."""
    base = sf_dir.rstrip("/")
    schema = spark.read.parquet(f"{base}/events.parquet").schema
    events = spark.readStream.schema(schema).parquet(f"{base}/events*.parquet")
    return lines_from(events, table(spark, sf_dir, "part"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` table: long multilingual texts with a unique
    ``doc_id``; the high-cardinality key for cleaning and grouping."""
    return table(spark, sf_dir, "documents")


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` seen as statement lines: the document id, its full
    text, its length as the amount and its language as the category. Used
    where a high-cardinality text key is wanted (about one distinct cleaned
    text per document)."""
    docs = documents(spark, sf_dir)
    return docs.select(
        F.col("doc_id").alias(LINE_COLUMNS.row_id),
        F.col("text").alias(LINE_COLUMNS.text),
        F.col("n_chars").cast(T.DoubleType()).alias(LINE_COLUMNS.amount),
        F.col("lang").alias(LINE_COLUMNS.category),
        F.lit(None).cast(T.DoubleType()).alias(LINE_COLUMNS.category_pct),
        F.lit(None).cast(T.TimestampNTZType()).alias(LINE_COLUMNS.ts),
        F.lit(None).cast(T.LongType()).alias(LINE_COLUMNS.user_id),
        F.col("source").alias(LINE_COLUMNS.institution),
    )


DOCUMENT_LINES_SQL = """
SELECT doc_id AS row_id, text, CAST(n_chars AS DOUBLE) AS amount, lang AS category,
       CAST(NULL AS DOUBLE) AS category_pct, CAST(NULL AS TIMESTAMP) AS ts,
       CAST(NULL AS BIGINT) AS user_id, source AS institution
FROM documents
"""
