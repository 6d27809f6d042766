"""Session defaults and the one place that decides where cut lineage is written."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_root() -> str:
    """One folder of this machine for the process."""
    return tempfile.mkdtemp(prefix="riskframe-")


def build_session(app_name: str = "riskframe", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators assume (UTC, AQE, no web page)."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Recording the call site of every column call costs more than most plans here.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of the cluster, read from ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine; on a cluster a missing setting is
    an error, because executors could not read each other's files.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    # A running session refuses to have the setting changed, so the folder is kept here.
    return _local_root()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written copy."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(checkpoint_root(df.sparkSession))
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str = "rows") -> DataFrame:
    """Like :func:`cut_lineage` for tables as long as the input: a written table, of which a reader takes only its columns."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for a written table or a stream checkpoint."""
    return f"{_scratch_folder(spark)}/{uuid.uuid4().hex}/{name}"


def _scratch_folder(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/riskframe/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete all written intermediate tables of this application. Results that weren't collected or written elsewhere read
    them, so call it when those are done."""
    from riskframe.sources import files

    files.delete(spark, _scratch_folder(spark))
