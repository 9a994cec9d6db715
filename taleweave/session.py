"""Session helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder of the session.

    A cluster names it in `spark.checkpoint.dir`. Only a local session without
    one gets a temporary folder, since executors elsewhere could not read it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        spark.sparkContext.setCheckpointDir(named)
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="run-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def working_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint folder for intermediate tables."""
    import uuid

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
