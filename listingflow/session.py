"""Session helpers: the shared work folder and writing intermediate tables to it."""

from __future__ import annotations

import tempfile
import uuid
from collections import Counter
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock, _writers, _before = Lock(), Counter(), {}


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; a cluster without it is an error,
    because a machine-local folder would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    existing = sc.getCheckpointDir()
    if existing is not None:
        return existing.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="listingflow-"))
    return sc.getCheckpointDir().rstrip("/")


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, below the application's id so that a finished run can be expired."""
    return f"{shared_root(spark)}/listingflow/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries run inside remove their shuffle files at their end; several threads may be inside at a time."""
    key = id(spark)
    with _lock:
        if not _writers[key]:
            _before[key] = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _writers[key] += 1
    try:
        yield
    finally:
        with _lock:
            _writers[key] -= 1
            if not _writers[key]:
                before = _before.pop(key)
                spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a result feeds several jobs: it cuts the lineage, and unlike cached blocks the files outlive
    the executors that wrote them. It also tells Spark the real size, so a later join broadcasts the table when
    it is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise reads it through a shuffle of its own,
    which AQE can split when a key is hot. What the write shuffled is removed at once, not when the driver happens to
    collect its garbage, so that the disk in use does not grow with the number of steps.
    """
    path = work_path(df.sparkSession, label)
    with _shuffles_removed(df.sparkSession):
        df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
