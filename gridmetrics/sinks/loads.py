"""Stored accumulators by load: a load that is sent again takes the place of what it sent before.

The accumulators of ``fold`` add up, so a load that is counted twice spoils every sum. Here they are stored by the
id of their load, with the version of the sending. Readers take the newest version of each load and
merge these. A load that is sent again without rows is empty from then on: each sending leaves a mark of its own.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from gridmetrics.operators.aggregate import fold, merge_folds
from gridmetrics.schema import METRICS, Metric
from gridmetrics.sinks.batches import compact_batches, read_batches, remove_replaced, write_batch

LOAD, VERSION, MARK = "load_id", "load_version", "load_mark"
_OWN = StructType(
    [StructField(LOAD, StringType()), StructField(VERSION, LongType()), StructField(MARK, StringType())]
)
_ROW, _SENT = "row", "sent"


class FoldStore:
    """Accumulators of loads in the table of batches at ``path``.

    ``schema`` is that of one load's accumulators, as ``fold`` makes them.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: StructType) -> None:
        self.spark, self.path, self.keys = spark, path, list(keys)
        self.schema = StructType([*_OWN.fields, *schema.fields])
        self._columns = schema.names

    @classmethod
    def like(
        cls,
        rows: DataFrame,
        path: str,
        keys: Sequence[str],
        metrics: Sequence[Metric] = METRICS,
        extremes: bool = True,
    ) -> FoldStore:
        """A store for what ``fold`` makes of tables like ``rows``."""
        folded = fold(rows.limit(0), keys, metrics, extremes)
        return cls(rows.sparkSession, path, keys, folded.schema)

    def send(self, load: str, folded: DataFrame, version: int | None = None) -> str:
        """Store the accumulators of a load in place of those it sent before; returns the batch's name.

        Versions grow with time unless given; of two sendings of a load the higher version counts,
        whichever ends first.
        """
        version = time.time_ns() if version is None else version
        own = [F.lit(load).alias(LOAD), F.lit(version).cast("long").alias(VERSION)]
        rows = folded.select(*own, F.lit(_ROW).alias(MARK), *self._columns)
        sent = self.spark.createDataFrame([(load, version, _SENT)], _OWN)
        return write_batch(rows.unionByName(sent, allowMissingColumns=True), self.path)

    def send_many(self, folded: DataFrame, load_column: str, version: int | None = None) -> str:
        """Store the accumulators of many loads, told apart by a column, in one job."""
        version = time.time_ns() if version is None else version
        own = [F.col(load_column).cast("string").alias(LOAD), F.lit(version).cast("long").alias(VERSION)]
        rows = folded.select(*own, F.lit(_ROW).alias(MARK), *self._columns)
        sent = rows.select(LOAD, VERSION, F.lit(_SENT).alias(MARK)).distinct()
        return write_batch(rows.unionByName(sent, allowMissingColumns=True), self.path)

    def _newest(self, rows: DataFrame | None = None) -> DataFrame:
        rows = read_batches(self.spark, self.path, self.schema) if rows is None else rows
        newest = rows.where(F.col(MARK) == _SENT).groupBy(LOAD).agg(F.max(VERSION).alias(VERSION))
        return rows.join(newest, [LOAD, VERSION]).select(rows.columns)

    def loads(self) -> DataFrame:
        """Loads with the version that counts."""
        return self._newest().where(F.col(MARK) == _SENT).select(LOAD, VERSION).distinct()

    def by_load(self) -> DataFrame:
        """The accumulators that count, by load."""
        return self._newest().where(F.col(MARK) == _ROW).select(LOAD, *self._columns)

    def merged(self) -> DataFrame:
        """Accumulators over all loads, each counted once."""
        return merge_folds(self.by_load().drop(LOAD), keys=self.keys)

    def compact(self, remove: bool = False) -> None:
        """Put all batches into one without the rows of older versions.

        Loads stay apart, so a load that is in it can still be sent again. Readers see the table before
        or after; see :mod:`gridmetrics.sinks.batches`.
        """
        compact_batches(self.spark, self.path, self.schema, only=self._newest)
        if remove:
            remove_replaced(self.spark, self.path)
