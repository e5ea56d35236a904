"""Session settings for large runs, and the shared folder for written tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# The number of shuffle partitions is not among these: it depends on the job, so it
# is left to the session, or to ``shuffle_partitions`` given what a job will shuffle.
SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply ``SCALE_SETTINGS`` where the session was given nothing else."""
    given = spark.sparkContext.getConf()
    for name, value in SCALE_SETTINGS.items():
        if not given.contains(name):
            spark.conf.set(name, value)
    return spark


def shuffle_partitions(shuffled_bytes: int, cores: int, task_bytes: int = 128 << 20) -> int:
    """Partitions for a shuffle of that size: tasks of ``task_bytes``, all cores busy."""
    return max(cores, -(-shuffled_bytes // task_bytes))


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a session whose tasks run in its own process may fall back to a folder of its
    own; a cluster of local processes may not. Checkpoints go below the same folder.
    """
    context = spark.sparkContext
    named, set_to = spark.conf.get("spark.checkpoint.dir", None), context.getCheckpointDir()
    if named:
        if not set_to or named.rstrip("/").removeprefix("file://") not in set_to:
            context.setCheckpointDir(named)
        return named
    if set_to:
        return set_to
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="lakemark-"))
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; nothing is there yet."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    for paths in _open_scopes:
        paths.append(path)
    return path


# Paths that were given out since each ``staging`` began.
_open_scopes: list[list[str]] = []


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """A stretch of work at whose end the tables it stored are removed from the shared folder.

    For jobs that have written their results, and for callers that have read theirs: a frame
    that reads a stored table cannot be read any more.
    """
    paths: list[str] = []
    _open_scopes.append(paths)
    try:
        yield
    finally:
        _open_scopes[:] = [scope for scope in _open_scopes if scope is not paths]
        for path in paths:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> bool:
    """Remove a file or folder of any file system that Spark reaches; false if it is not there."""
    jvm, context = spark._jvm, spark.sparkContext._jsc
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context.hadoopConfiguration()).delete(place, True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Its lineage ends there, it is computed once however often it is read, and a join
    with it is between plain shuffled rows, which AQE can split.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
