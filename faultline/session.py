"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "faultline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on; the cluster sets the rest."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for intermediate tables, below the shared folder the cluster names.

    Only a local session may fall back to a temporary folder: on a cluster the executors
    would each see a different one.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return os.path.join(base, f"{purpose}-{uuid.uuid4().hex}")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, read from a table written to the shared folder: for results that are read
    more than once, or that must stay as they are when an executor is lost."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
