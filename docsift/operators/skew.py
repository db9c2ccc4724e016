"""Intermediate results that hold up under lost executors."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .stored import shared_folder


def durable(df: DataFrame) -> DataFrame:
    """Computed once and checkpointed in the cluster's folder (``spark.checkpoint.dir``)."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
