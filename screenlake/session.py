"""Session helpers: lineage cuts and shared scratch folders."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Long texts that a Python worker gets at once.
TEXTS_AT_ONCE = 500


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints, taken from the session's own setting.

    A folder is made up only for a local master without the setting; on a cluster a
    machine-local folder would be lost with its executor, so that is refused.
    """
    sc = spark.sparkContext
    wanted = spark.conf.get(CHECKPOINT_SETTING, None)
    current = sc.getCheckpointDir()
    if wanted:
        if current is None or wanted.rstrip("/") not in current:
            sc.setCheckpointDir(wanted)
    elif current is None:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
        made = tempfile.mkdtemp(prefix="screenlake-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        sc.setCheckpointDir(made)
    return sc.getCheckpointDir()


def stable(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later jobs read the same rows even if executors are lost."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def small_batches(spark: SparkSession, rows: int = TEXTS_AT_ONCE) -> Iterator[None]:
    """Jobs that run inside send at most so many rows at once to a Python worker, which holds each batch several times.

    A lower setting of the session stays.
    """
    before = spark.conf.get(BATCH_SETTING)
    if 0 < int(before) <= rows:
        yield
        return
    spark.conf.set(BATCH_SETTING, rows)
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that `shared_path` gave, once nothing reads it any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
