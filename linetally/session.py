"""Session helpers: a local session for tests and benchmarks, the shared
folder for intermediate tables, and materialisation of an intermediate
result into that folder.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_APP_FOLDER = "linetally"


def local_session(cpus: int | str = "*", partitions: int = 8, app: str = "linetally") -> SparkSession:
    """A local session configured like the tests and the benchmark expect:
    AQE on, UTC session zone, no UI."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables that every executor can read.

    Taken from the session: the context's checkpoint directory, else the
    ``spark.checkpoint.dir`` setting. Only a local-mode session without
    either gets a private temporary folder (as in tests); on a cluster a
    missing setting is an error, since a machine-local folder would not be
    visible to the other executors.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session has no context
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage")
        return folder.rstrip("/")
    folder = sc.getCheckpointDir()
    if not folder:
        folder = sc.getConf().get("spark.checkpoint.dir", None)
        if folder:
            sc.setCheckpointDir(folder)
            folder = sc.getCheckpointDir() or folder
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):  # local-cluster has several executors
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at shared storage "
                "(HDFS, S3, ...) so intermediate tables survive executor loss"
            )
        folder = tempfile.mkdtemp(prefix="linetally-ckpt-")
        sc.setCheckpointDir(folder)
        folder = sc.getCheckpointDir() or folder
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the shared folder, which belongs to the innermost open :class:`Scratch`, if there is one."""
    path = f"{shared_folder(spark)}/{_APP_FOLDER}/{label}-{uuid.uuid4().hex}"
    owner = _owner.get()
    if owner is not None:
        owner.paths.append(path)
    return path


_owner: ContextVar[Scratch | None] = ContextVar("linetally_scratch", default=None)


class Scratch:
    """Owner of the intermediate tables that library calls write while it is open::

        with Scratch(spark):
            report = profile_job(...)
            report.profile.write.saveAsTable("profile")

    :meth:`close`, or the end of the block, deletes them; frames that read them are of no use after that. Without an owner they stay
    until somebody clears the shared folder."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []
        self._token = None

    def __enter__(self) -> Scratch:
        self._token = _owner.set(self)
        return self

    def __exit__(self, *exc) -> None:
        if self._token is not None:
            _owner.reset(self._token)
            self._token = None
        self.close()

    def close(self) -> None:
        """Deletes the tables written so far."""
        while self.paths:
            remove_folder(self.spark, self.paths.pop())


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back.

    This is an action. It cuts the lineage (a lost executor later costs a
    re-read of this table, not a re-run of the job that produced it), gives
    the optimizer real file sizes for its broadcast decisions, and lets
    several downstream branches share one computation of ``df`` instead of
    each re-scanning the source.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Deletes a folder that the library has written, on whatever storage it lies. Returns whether it was there."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
