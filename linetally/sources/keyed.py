"""Keyed tables: rows found by key, updates that rewrite only what they touch (S4).

A keyed table is a folder. Its rows lie in Parquet files by bucket, a hash of the
key; each write is a *generation* of its own, and a *snapshot* names the
generation of each bucket that counts::

    <path>/data/generation=3/_bucket=17/part-...parquet
    <path>/snapshots/version=3/part-...parquet      (_bucket, generation), one file

An update reads and writes the buckets of its keys only, as a new generation, and then
publishes a snapshot, which is one file that appears at once. Until then readers see the
version before; a reader that has begun goes on with the files of its version, which
stay until :meth:`KeyedTable.vacuum`. A job that dies in between leaves files that no
snapshot names. One writer at a time: a second one that publishes the same version fails.

Keys are unique, so buckets are as even as their hash, and no key is hot. Choose the
number of buckets so that one holds some hundred MB; it is fixed when the table is made.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_folder

_BUCKET = "_bucket"


class KeyedTable:
    """A keyed table at ``path`` on shared storage. ``keys`` and ``buckets`` are read from its first snapshot."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        made = spark.read.parquet(f"{self.path}/table").first()
        self.keys, self.buckets = list(made["keys"]), made["buckets"]

    # -- writing ----------------------------------------------------------

    @classmethod
    def create(cls, rows: DataFrame, path: str, keys: Sequence[str], buckets: int) -> KeyedTable:
        """A new table with ``rows``, whose keys must be unique (nulls are a key like any other). The rows are shuffled once."""
        if buckets < 1:
            raise ValueError("buckets must be >= 1")
        keys = _known(keys, rows)
        path = path.rstrip("/")
        _check_unique(rows, keys)
        spark = rows.sparkSession
        spark.createDataFrame([(keys, buckets)], "keys array<string>, buckets int").coalesce(1).write.mode("errorifexists").parquet(f"{path}/table")
        table = cls(spark, path)
        table._write(rows.withColumn(_BUCKET, table._bucket_of(rows)), 1)
        table._publish(1, {b: 1 for b in range(buckets)})
        return table

    def upsert(self, updates: DataFrame) -> list[int]:
        """Sets the columns that ``updates`` has in the rows of its keys, and adds rows for new keys; columns that only the table has
        keep their values (null in new rows), columns that only ``updates`` has are added (null in other rows). Several updates
        of one key fail, as no order says which is the last. Returns the buckets rewritten.

        Actions: the check of the keys, the list of touched buckets (at most ``buckets`` numbers), the write, the snapshot."""
        keys = _known(self.keys, updates)
        schema = {f.name.lower(): f.dataType for f in self.read().schema.fields}
        # equal keys must hash alike, so they have the table's type
        updates = updates.select(*[F.col(f"`{c}`").cast(schema[c.lower()]).alias(c) if c.lower() in schema else F.col(f"`{c}`") for c in updates.columns])
        _check_unique(updates, keys)
        updates = updates.withColumn(_BUCKET, self._bucket_of(updates))
        touched = sorted(r[0] for r in updates.select(_BUCKET).distinct().collect())
        if not touched:
            return []
        version, live = self._snapshot()
        old = self._rows({b: live[b] for b in touched}, keep_bucket=True)
        self._write(_merged(old, updates, keys), version + 1)
        self._publish(version + 1, live | {b: version + 1 for b in touched})
        return touched

    def _bucket_of(self, rows: DataFrame) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, generation: int) -> None:
        """One file for each bucket: a bucket is in one task."""
        rows.repartition(_BUCKET).write.mode("errorifexists").partitionBy(_BUCKET).parquet(f"{self.path}/data/generation={generation}")

    def _publish(self, version: int, live: dict[int, int]) -> None:
        rows = self.spark.createDataFrame(sorted(live.items()), "_bucket int, generation int")
        rows.coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/snapshots/version={version}")

    def vacuum(self) -> list[int]:
        """Deletes generations that the current version does not name (readers of older versions fail after that). Returns them."""
        _, live = self._snapshot()
        found = {r[0] for r in self.spark.read.parquet(f"{self.path}/snapshots").select("generation").distinct().collect()}
        dead = sorted(found - set(live.values()))
        for g in dead:
            remove_folder(self.spark, f"{self.path}/data/generation={g}")
        return dead

    # -- reading ----------------------------------------------------------

    def versions(self) -> list[int]:
        return sorted(r[0] for r in self.spark.read.parquet(f"{self.path}/snapshots").select("version").distinct().collect())

    def _snapshot(self, version: int | None = None) -> tuple[int, dict[int, int]]:
        """A version (default the last) and the generation of each bucket in it: at most ``buckets`` pairs."""
        version = self.versions()[-1] if version is None else version
        rows = self.spark.read.parquet(f"{self.path}/snapshots/version={version}").collect()
        return version, {r["_bucket"]: r["generation"] for r in rows}

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (default the last)."""
        return self._rows(self._snapshot(version)[1])

    def lookup(self, wanted: DataFrame) -> DataFrame:
        """The rows whose key is in ``wanted``; only their buckets are read."""
        keys = _known(self.keys, wanted)
        rows = self.read()
        types = {f.name: f.dataType for f in rows.schema.fields}
        asked = wanted.select(*[F.col(f"`{k}`").cast(types[k]).alias(k) for k in keys]).distinct()
        touched = [r[0] for r in asked.select(self._bucket_of(asked).alias(_BUCKET)).distinct().collect()]
        live = self._snapshot()[1]
        found = self._rows({b: live[b] for b in touched}) if touched else rows.limit(0)
        a = asked.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)])
        return found.join(a, [found[f"`{k}`"].eqNullSafe(a[f"_k{i}"]) for i, k in enumerate(keys)], "left_semi")

    def _rows(self, live: dict[int, int], keep_bucket: bool = False) -> DataFrame:
        """The given buckets of the given generations; other files are not read (the bucket is a partition column)."""
        by_generation = defaultdict(list)
        for bucket, generation in live.items():
            by_generation[generation].append(bucket)
        parts = None
        for generation in sorted(by_generation):
            part = self.spark.read.parquet(f"{self.path}/data/generation={generation}")
            part = part.where(F.col(_BUCKET).isin(by_generation[generation]))
            parts = part if parts is None else parts.unionByName(part, allowMissingColumns=True)
        # columns that a later generation added come last
        rows = parts.select(*[c for c in parts.columns if c != _BUCKET], F.col(_BUCKET).cast("int").alias(_BUCKET))
        return rows if keep_bucket else rows.drop(_BUCKET)


def _known(keys: Sequence[str], rows: DataFrame) -> list[str]:
    keys = list(keys)
    missing = [k for k in keys if k not in rows.columns]
    if missing or not keys:
        raise ValueError(f"keys {missing or keys} must be columns of the rows")
    return keys


def _check_unique(rows: DataFrame, keys: Sequence[str]) -> None:
    """Fails if a key occurs twice. Only keys are shuffled, counted before that."""
    again = rows.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    if not again.isEmpty():
        raise ValueError(f"several rows for one key {list(keys)}")


def _merged(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Old and new rows of the touched buckets, merged by key. Both are dealt by bucket, which serves the grouping and the write: one shuffle."""
    columns = [*old.columns, *[c for c in new.columns if c not in old.columns]]
    own = [c for c in columns if c not in keys and c != _BUCKET]
    tagged = old.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)), allowMissingColumns=True)
    # of each kind there is one row a key at most, so there is nothing to choose
    pick = lambda which: F.first(F.when(F.col("_new") == which, F.struct(*[F.col(f"`{c}`") for c in own], F.lit(1).alias("_there"))), ignorenulls=True)
    by = [F.col(f"`{k}`") for k in keys]
    both = tagged.repartition(_BUCKET).groupBy(_BUCKET, *by).agg(pick(False).alias("_was"), pick(True).alias("_is"))
    out = []
    for c in columns:
        if c in keys or c == _BUCKET:
            out.append(F.col(f"`{c}`"))
        elif c in new.columns:
            out.append(F.when(F.col("_is").isNotNull(), F.col(f"_is.`{c}`")).otherwise(F.col(f"_was.`{c}`")).alias(c))
        else:
            out.append(F.col(f"_was.`{c}`").alias(c))
    return both.select(*out)
