"""Feeding rows to Python in Arrow batches of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Rows and bytes of one Arrow batch, unless the session says otherwise. A single longer row is a batch.
BATCH_ROWS = 2000
BATCH_BYTES = 16 << 20
#: Bytes of texts worked on together (a longer text alone); the more, the fewer words are looked up twice.
GATHERED_BYTES = 12 << 20


def bound_batches(df: DataFrame) -> None:
    """Keep the batches sent to Python small, whatever the length of the texts."""
    conf = df.sparkSession.conf
    for key, default, value in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", BATCH_ROWS),
        ("spark.sql.execution.arrow.maxBytesPerBatch", str(2**31 - 1), BATCH_BYTES),
    ):
        if conf.get(key, default) in (default, "-1", "0"):
            conf.set(key, str(value))


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``work`` over every Arrow batch of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield work(batch)

    bound_batches(df)
    return df.mapInArrow(run, schema)


def gathered(batches: Iterator[pa.RecordBatch], least: int = GATHERED_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches put together until they have as many bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= least:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)
