"""Where intermediate tables are written."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SHARED_FOLDER = "spark.checkpoint.dir"
WAREHOUSE = "spark.sql.warehouse.dir"


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    """Have the file system drop the folder when the application ends."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(context._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)


def new_folder(spark: SparkSession, name: str) -> str:
    """An unused path for one intermediate table, in a folder that every executor can reach.

    That is the folder in ``spark.checkpoint.dir`` or, where none is set, the session's warehouse.
    The table is an ordinary written one, so it outlives lost executors; it goes with the
    application.
    """
    base = spark.conf.get(SHARED_FOLDER, None) or spark.conf.get(WAREHOUSE)
    path = f"{base.rstrip('/')}/gridmetrics/{name}-{uuid.uuid4().hex}"
    _remove_at_exit(spark, path)
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


_made: ContextVar[list[str] | None] = ContextVar("gridmetrics_folders", default=None)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it; one that is gone already is no error."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def passing_folders(spark: SparkSession) -> Iterator[None]:
    """Delete at the end the folders that ``new_folder`` gives out inside, in this thread.

    What is computed from them has to be written elsewhere before.
    """
    token = _made.set([])
    try:
        yield
    finally:
        made = _made.get() or []
        _made.reset(token)
        for path in made:
            drop_folder(spark, path)


def stored(df: DataFrame, name: str = "step") -> DataFrame:
    """``df`` computed once, written to a folder of its own and read back.

    What follows does not go back to the input where an executor is lost.
    """
    path = new_folder(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)  # the folder is there, empty
    return df.sparkSession.read.schema(df.schema).parquet(path)
