"""Raw text lines to the energy table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmetrics.functions.timeparts import with_event_time
from gridmetrics.schema import ENERGY_SCHEMA

_FIELDS = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in ENERGY_SCHEMA)


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Comma-separated lines as country, event time and metrics, read as the CSV reader does.

    Quotes are understood; a missing, empty or unreadable field is NULL, and a bad line never fails
    the job.
    """
    fields = lines.select(F.from_csv(column, _FIELDS).alias("fields"))
    return with_event_time(fields.select("fields.*"))
