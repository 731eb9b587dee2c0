"""The hourly energy table, its metrics, and the names of everything computed from it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DoubleType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# The input layout. CSV files bind to it by position, Parquet files by name.
COUNTRY = "Country"
EVENT_TIME = "event_time"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

ENERGY_SCHEMA = StructType(
    [
        StructField(COUNTRY, StringType()),
        StructField(EVENT_TIME, StringType()),
        StructField("CarbonDirect", DoubleType()),
        StructField("CFEpercent", DoubleType()),
    ]
)
# The same table with times already parsed, for copies that are read again and again.
TYPED_SCHEMA = StructType(
    [
        StructField(field.name, TimestampNTZType()) if field.name == EVENT_TIME else field
        for field in ENERGY_SCHEMA
    ]
)
CSV_HEADER = ",".join(ENERGY_SCHEMA.names)


@dataclass(frozen=True)
class Metric:
    """A measured column, the stem of its result columns, and its tag in long results."""

    column: str
    name: str
    tag: str


# The two metrics and the words used for them in result tables.
CARBON = Metric("CarbonDirect", "carbon_intensity", "carbon-intensity")
CFE = Metric("CFEpercent", "cfe_percentage", "cfe")
METRICS = (CARBON, CFE)

# Derived time columns.
YEAR = "record_year"
MONTH = "record_month"
HOUR = "record_hour"
MONTH_TIMESTAMP = "month_timestamp"
HOUR_TIMESTAMP = "hour_timestamp"

# The five-number result.
SUMMARY_COLUMNS = (COUNTRY, "data", "min", "perc_25", "perc_50", "perc_75", "max")
QUARTILES = (0.25, 0.5, 0.75)
PERCENTILE_ACCURACY = 100

# Countries as codes and as written out in CSV files.
COUNTRY_CODES = {"Italy": "IT", "Sweden": "SE"}

TOP_K = 5
