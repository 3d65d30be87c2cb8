"""Pieces that several operators of this package share."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator
from functools import wraps
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that separate words: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def carried(df: DataFrame, made: Iterable[str], columns: Iterable[str] | None = None) -> list[str]:
    """Columns of ``df`` (of ``columns``, if given) that an operator passes on: not
    those it makes itself, nor those that start with an underscore, which are
    its own helpers. Names differ only in more than case."""
    taken = {m.lower() for m in made}
    return [c for c in (df.columns if columns is None else columns) if c.lower() not in taken and c[:1] != "_"]


def whole_text(text: Column | str) -> Column:
    """The text, null read as empty."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(c.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Array of the words of a non-null text, in order (JVM side)."""
    body = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(body) == 0, F.array().cast("array<string>")).otherwise(F.split(body, SPACE_RUN))


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only, so that every engine agrees on the result."""
    return F.translate(c, _UPPER, _UPPER.lower())


def byte_words(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text with A-Z lower-cased. ``bytes.split()`` cuts at
    exactly the bytes of :data:`SPACES`, ``bytes.lower()`` changes A-Z only."""
    return text.lower().split() if text else []


#: Large tables of the operator that this worker runs, by key.
_tables: dict[tuple, Any] = {}


def worker_table(key: tuple, make: Callable[[], Any]) -> Any:
    """A large table that a worker keeps from task to task, made anew only if another one was held since."""
    if key not in _tables:
        release_tables()
        _tables[key] = make()
    return _tables[key]


def release_tables() -> None:
    """Drops what :func:`worker_table` holds. Spark hands workers on from job to job, so an operator calls this at the start
    of a task that has no use for another's tables."""
    if _tables:
        _tables.clear()
        gc.collect()


def returning_memory(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The map over Arrow batches, which returns at its end the memory that Arrow keeps for later: its worker may idle while others work."""
    @wraps(run)
    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return lean


def slices(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches, some rows at a time, for results that carry texts."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)
