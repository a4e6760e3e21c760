"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "shelfwise", master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution; cluster sizing stays with the submitter."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A folder is made here only for a local master with none configured (tests).
    On a cluster a missing setting is an error: a machine-local folder would
    lose the data together with its executor.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="shelfwise-"))
    return context.getCheckpointDir().rstrip("/")


def workers_see_library(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it (elsewhere it is sent with --py-files)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; ``job_scratch`` removes it at a job's end."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


@contextmanager
def job_scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what was put below the shared folder inside, and only that.

    For a job that writes its results elsewhere: frames made inside can't be read afterwards.
    """
    start = len(_scratch)
    try:
        yield
    finally:
        for path in _scratch[start:]:
            delete_path(spark, path)
        del _scratch[start:]


def delete_path(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame below the shared folder and read it back.

    Cuts the lineage: what is computed from here on sees one fixed set of rows,
    and a lost executor costs a read, not the work before it. As a Parquet table
    it is read by columns and with known sizes.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is run inside gives up its shuffle files when it ends, not when the driver collects its garbage.

    For frames that are run once, as those that are materialized.
    """
    before = spark.conf.get(CLEANUP_SETTING, None)
    spark.conf.set(CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_SETTING)
        else:
            spark.conf.set(CLEANUP_SETTING, before)
