"""Cutting the lineage of frames that a loop builds on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for what driver and executors share.

    Only a local session without such a folder gets a temporary one; on a
    cluster a missing folder is an error, because executors could not share it.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get(CHECKPOINT_CONF)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError(f"set {CHECKPOINT_CONF} to a shared folder")
            folder = tempfile.mkdtemp(prefix="fundglean-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint into the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
