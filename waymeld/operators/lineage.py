"""Cutting the lineage of tables that loops build on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """df as stored in the shared folder that spark.checkpoint.dir names; lost executors lose none of it.

    A local session without that setting gets a folder of its own; a cluster without it is an error.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="waymeld-"))
    return df.checkpoint()
