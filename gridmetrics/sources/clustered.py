"""The energy table laid out so that a scan of one country and time reads little else.

Rows are dealt out by range over country and time and sorted. So each row group covers one country, or a
few neighbouring ones, and a stretch of time, and its statistics let a scan pass over it unread. Countries
that lie between the bounds of a row group without being in it are told by a bloom filter. Unlike folders
by country, the layout needs no listing of folders, has files of even size, and skips by time as well.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from gridmetrics.functions.labels import of_country
from gridmetrics.functions.timeparts import with_event_time
from gridmetrics.schema import (
    COUNTRY,
    COUNTRY_CODES,
    ENERGY_SCHEMA,
    EVENT_TIME,
    TYPED_SCHEMA,
)

#: The day of the event time, kept beside it: Spark compares days with Parquet's statistics, but not zone-less times.
DAY = "event_day"
_SCHEMA = StructType([*TYPED_SCHEMA.fields, StructField(DAY, DateType())])

#: Bytes of a row group: small enough to be skipped on its own, large enough for long column chunks.
ROW_GROUP_BYTES = 32 << 20
#: Countries for which the bloom filter of a row group is sized.
COUNTRIES = 1000


def write_clustered(
    df: DataFrame, path: str, row_group_bytes: int = ROW_GROUP_BYTES, countries: int = COUNTRIES
) -> None:
    """Write the energy table with parsed times, clustered by country and time, replacing what is there.

    A country that outgrows a partition is cut by time, so one dominant country is spread over tasks. The
    country is stored without a dictionary, as Parquet writes bloom filters only then.
    """
    energy = with_event_time(df.select(*ENERGY_SCHEMA.names))
    energy = energy.withColumn(DAY, F.col(EVENT_TIME).cast("date"))
    order = [F.col(COUNTRY).asc_nulls_first(), F.col(EVENT_TIME).asc_nulls_first()]
    (
        energy.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("parquet.block.size", row_group_bytes)
        .option(f"parquet.bloom.filter.enabled#{COUNTRY}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{COUNTRY}", countries)
        .option(f"parquet.enable.dictionary#{COUNTRY}", "false")
        .parquet(path)
    )


def read_clustered(
    spark: SparkSession,
    path: str,
    country: str | None = None,
    since: datetime | None = None,
    until: datetime | None = None,
    codes: Mapping[str, str] = COUNTRY_CODES,
) -> DataFrame:
    """The table that ``write_clustered`` wrote: of one country, and from ``since`` up to ``until``, if given.

    The bounds are wall clock times; ``until`` itself is left out. All filters reach the scan.
    """
    energy = spark.read.schema(_SCHEMA).parquet(path)
    if country is not None:
        energy = of_country(energy, country, codes)
    if since is not None:
        energy = energy.filter((F.col(DAY) >= _day(since)) & (F.col(EVENT_TIME) >= _time(since)))
    if until is not None:
        energy = energy.filter((F.col(DAY) <= _day(until)) & (F.col(EVENT_TIME) < _time(until)))
    return energy.drop(DAY)


def _time(bound: datetime) -> Column:
    return F.lit(bound.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def _day(bound: datetime) -> Column:
    return F.lit(bound.date())
