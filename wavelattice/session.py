"""Session construction and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool
from urllib.parse import urlsplit

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "wavelattice", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution and Arrow batches sized for long wave arrays."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # checkpoints go once nothing refers to them any more
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # One wave of 1016 doubles is 8 KB: 2048 rows keep a batch near 16 MB.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _shared_root(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = os.path.join(tempfile.gettempdir(), "wavelattice-scratch")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for an intermediate table in the folder shared by the cluster."""
    return f"{_shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def files_at(path: str) -> tuple:
    """The ``pyarrow`` file system and the path in it of a folder that tasks read without Spark."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(path) if urlsplit(path).scheme else (fs.LocalFileSystem(), path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table (see :func:`scratch_path`) that nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably so that a lost executor does not replay earlier rounds."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(_shared_root(df.sparkSession))
    return df.checkpoint(eager=True)


def fresh_cut(df: DataFrame) -> DataFrame:
    """:func:`cut_lineage` for loops: the size estimate of the plan is dropped too.

    A checkpointed table carries the estimate of the plan it came from. Joins multiply estimates, so in a loop their digits
    grow round by round, until planning takes longer than the work; actual sizes are known to adaptive execution anyway.
    """
    spark, kept = df.sparkSession, cut_lineage(df)
    plain = spark._jsparkSession.internalCreateDataFrame(kept._jdf.queryExecution().toRdd(), kept._jdf.schema(), False)
    return DataFrame(plain, spark)


def concurrently(spark: SparkSession, run: Callable, tasks: Sequence, parallelism: int) -> list:
    """``[run(t) for t in tasks]`` with the Spark jobs submitted from several driver threads.

    For independent model fits: each fit is distributed, and together they keep the cluster busy.
    """
    pool = ThreadPool(max(1, min(parallelism, len(tasks))))
    try:
        return pool.map(inheritable_thread_target(spark)(run), tasks, chunksize=1)
    finally:
        pool.close()
