"""The table of run times: one row per run, in batches of any number of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmetrics.sinks.batches import compact_batches, read_batches, remove_replaced, write_batch

# Columns and precision of the run time table.
RUN_SCHEMA = "query int, workers_number int, tempo_totale double"
RUN_DECIMALS = 6


def append_runs(runs: DataFrame, path: str, fmt: str = "csv") -> None:
    """Add runs to the table at ``path`` as one batch, in one job.

    Every batch has a folder of its own: jobs that finish together would otherwise clear away each
    other's unfinished files.
    """
    columns = [F.col(field.split()[0]).cast(field.split()[1]) for field in RUN_SCHEMA.split(", ")]
    typed = runs.select(*columns)
    rounded = typed.withColumn("tempo_totale", F.round("tempo_totale", RUN_DECIMALS))
    write_batch(rounded, path, fmt)


def append_run(
    spark: SparkSession, path: str, query: int, workers: int, seconds: float, fmt: str = "csv"
) -> None:
    """Add one run to the table at ``path``."""
    run = spark.createDataFrame([(query, workers, float(seconds))], RUN_SCHEMA)
    append_runs(run.coalesce(1), path, fmt)


def read_runs(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """All runs; a batch that is being written, or was replaced by a compaction, is not among them."""
    return read_batches(spark, path, RUN_SCHEMA, fmt)


def compact_runs(spark: SparkSession, path: str, fmt: str = "csv", remove: bool = False) -> None:
    """Put all batches into one. Readers see the runs before or after, never half of them.

    With ``remove`` the replaced batches are deleted, which is safe once no reader still holds them.
    """
    compact_batches(spark, path, RUN_SCHEMA, fmt)
    if remove:
        remove_replaced(spark, path)
