"""Tables of batches: appended whole, replaced whole, and compacted under their readers.

A table is a folder with one sub-folder per batch. Spark writes the files of a batch; what makes it part of
the table is a small note put there last, under its final name at once by a rename. The note names the
batches that this one replaces. A reader takes the noted batches that no note replaces, so it sees a
batch whole or not at all, and at a compaction either the many batches or the one. Replaced batches stay until
``remove_replaced``, so readers that listed them before can finish.

The driver lists batches and reads their notes: their number is that of the loads since the last
compaction. Rows never go through it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from gridmetrics.sources.readers import checked_format

NOTE = "_batch.json"


class _Files:
    """The file system of a path, as Spark sees it."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark.sparkContext._jvm
        self.root = self._jvm.org.apache.hadoop.fs.Path(path)
        self.system = self.root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, *names: str):
        return self._jvm.org.apache.hadoop.fs.Path(self.root, "/".join(names))

    def put(self, text: str, *names: str) -> None:
        """Write a small file that is there whole or not at all."""
        target = self.path(*names)
        draft = self.path(*names[:-1], f"_draft-{uuid.uuid4().hex}")
        stream = self.system.create(draft, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self.system.rename(draft, target):
            raise OSError(f"{target} cannot be put in place")

    def text(self, *names: str) -> str:
        stream = self.system.open(self.path(*names))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def folders(self) -> list[str]:
        if not self.system.exists(self.root):
            return []
        found = (status for status in self.system.listStatus(self.root) if status.isDirectory())
        return sorted(status.getPath().getName() for status in found)

    def has(self, *names: str) -> bool:
        return self.system.exists(self.path(*names))

    def drop(self, *names: str) -> None:
        self.system.delete(self.path(*names), True)


@dataclass(frozen=True)
class Batches:
    """Noted batches of a table: those that count and those that were replaced."""

    live: tuple[str, ...]
    replaced: tuple[str, ...]


def list_batches(spark: SparkSession, path: str) -> Batches:
    files = _Files(spark, path)
    notes = {name: json.loads(files.text(name, NOTE)) for name in files.folders() if files.has(name, NOTE)}
    gone = {name for note in notes.values() for name in note["replaces"]}
    return Batches(
        tuple(name for name in notes if name not in gone),
        tuple(name for name in notes if name in gone),
    )


def write_batch(
    df: DataFrame, path: str, fmt: str = "parquet", replaces: Iterable[str] = ()
) -> str:
    """Add ``df`` as one batch, written in one job, in place of the batches named; returns its name."""
    spark, name = df.sparkSession, f"batch-{uuid.uuid4().hex}"
    writer = df.write.option("header", "true").format(checked_format(fmt))
    writer.save(f"{path.rstrip('/')}/{name}")
    _Files(spark, path).put(json.dumps({"replaces": sorted(replaces)}), name, NOTE)
    return name


def read_batches(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "parquet",
    names: Sequence[str] | None = None,
) -> DataFrame:
    """All rows of the batches that count, or of those named; an empty table if there are none."""
    names = list_batches(spark, path).live if names is None else names
    if not names:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("header", "true").format(checked_format(fmt))
    return reader.load([f"{path.rstrip('/')}/{name}" for name in names])


def compact_batches(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "parquet",
    only: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> str | None:
    """Put the batches that count into one, in few files; returns its name, None if there is nothing to do.

    ``only`` may leave out rows that count no longer. Batches that are added meanwhile stay beside the new
    one. Two compactions at once would both take the same batches, so the caller runs one at a time.
    """
    live = list_batches(spark, path).live
    if len(live) < 2:
        return None
    rows = only(read_batches(spark, path, schema, fmt, live))
    return write_batch(rows.hint("rebalance"), path, fmt, live)


def remove_replaced(spark: SparkSession, path: str) -> int:
    """Delete replaced batches, once no reader can still hold their names; returns their number.

    A note is deleted after the notes that it replaces, so no replaced batch comes back.
    """
    files, replaced = _Files(spark, path), list_batches(spark, path).replaced
    waiting = {name: set(json.loads(files.text(name, NOTE))["replaces"]) for name in replaced}
    while waiting:
        ready = [name for name, before in waiting.items() if not before & waiting.keys()]
        for name in ready:
            files.drop(name)
            del waiting[name]
    return len(replaced)
