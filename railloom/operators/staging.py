"""Intermediate tables in the shared scratch folder of the cluster.

A staged table survives the loss of executors and pins down what a later pass reads.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock, _running = threading.Lock(), {}


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries begun here delete their shuffle files when they end, and not when the driver collects its garbage.

    The setting is that of the session while any thread is in here, and afterwards what it was before.
    """
    with _lock:
        n, before = _running.get(spark, (0, None))
        if not n:
            before = spark.conf.get(CLEANUP, None)
            spark.conf.set(CLEANUP, "true")
        _running[spark] = n + 1, before
    try:
        yield
    finally:
        with _lock:
            n, before = _running.pop(spark)
            if n > 1:
                _running[spark] = n - 1, before
            elif before is None:
                spark.conf.unset(CLEANUP)
            else:
                spark.conf.set(CLEANUP, before)


def scratch_root(spark: SparkSession) -> str:
    """Folder named by the session."""
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage", compression: str = "snappy") -> DataFrame:
    """Write once, read back: the result is computed one time and its lineage ends here."""
    path = scratch_path(df.sparkSession, label)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
