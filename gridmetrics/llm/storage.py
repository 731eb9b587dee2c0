"""Cutting lineage through the folder that driver and executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridmetrics.workspace import new_folder


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; one below the warehouse is set only where none is set."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir", None)
        context.setCheckpointDir(named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints")
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and read back as a table in the shared folder, so lost executors cost nothing.

    A table, as a checkpoint carries the constraints of its plan on: over the rounds of a loop they grow
    until the driver plans longer than the executors work. It is compressed as well.
    """
    path = new_folder(df.sparkSession, "step")
    df.write.mode("overwrite").parquet(path)  # the folder is there, empty
    return df.sparkSession.read.schema(df.schema).parquet(path)
