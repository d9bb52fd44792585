"""Shared-folder access: checkpoints and tables handed from stage to stage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_HASHED = {"tinyint", "smallint", "int", "bigint", "float", "double", "decimal", "string", "boolean", "date", "timestamp"}
_handed_over: dict[tuple[str, str, str], str] = {}
_stored: ContextVar[list[str] | None] = ContextVar("_stored", default=None)  # by the build of a handed table


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if named:
        if current is None:
            sc.setCheckpointDir(named)
        return named
    if current is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="reviewlens-"))
        current = sc.getCheckpointDir()
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/reviewlens/{name}-{uuid.uuid4().hex}"


@contextmanager
def dropping_shuffles(spark: SparkSession):
    """Drop the shuffle files of a table as soon as it is written; else they stay
    on the executors' disks until the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _drop(spark: SparkSession, path: str) -> None:
    """Delete a table that :func:`store` wrote."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def hand_over(
    spark: SparkSession, scope: str, name: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """Write a stage's table once per application and read it back from then on.

    Tables that ``build`` keeps with :func:`store` go when its own is written, so
    nothing that outlives ``build`` may read them.
    """
    key = (spark.sparkContext.applicationId, scope, name)
    if key not in _handed_over:
        path = scratch_path(spark, name)
        outer, own = _stored.get(), []
        _stored.set(own)
        try:
            table = build()
            with dropping_shuffles(spark):
                table.write.mode("overwrite").parquet(path)
        finally:
            _stored.set(outer)
        _handed_over[key] = path
        for used in own:  # what ``build`` stored on its way is in the table now
            _drop(spark, used)
    return spark.read.parquet(_handed_over[key])


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage, and
    later readers fetch only the columns they use."""
    path = scratch_path(df.sparkSession, name)
    with dropping_shuffles(df.sparkSession):
        df.write.parquet(path)
    if _stored.get() is not None:
        _stored.get().append(path)
    return df.sparkSession.read.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Lay a training table out for an iterative fit, the same way however its
    input was cut: dealt by a hash of its plain columns into the session's
    shuffle partitions, in the order of that hash, and written once."""
    plain = [c for c, kind in df.dtypes if kind.split("(")[0] in _HASHED]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.xxhash64(*plain)
    dealt = df.repartition(parts, place).sortWithinPartitions(place, *plain)
    return store(dealt, "training")


@contextmanager
def small_batches(spark: SparkSession, rows: int):
    """Bound the rows per Arrow batch while tables with wide rows are written."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)
