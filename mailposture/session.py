"""Lineage cuts in the shared folder that the session names."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use spark.checkpoint.dir. Where none is named, a temporary folder serves a local session, as in tests; on a
    cluster executors would not see it, so that raises."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", "")
    if not named and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared checkpoint folder and read from there afterwards."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
