"""Event times and the calendar parts the questions group by.

Times are kept as ``timestamp_ntz``: the files hold wall clock text without a zone, and a
zone-less value gives the same year, month and hour under every session zone (a zoned one would
move 02:00 on the night the clocks change).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampType

from gridmetrics.schema import EVENT_TIME, HOUR, MONTH, TIME_FORMAT, YEAR

_TIME_PATTERN = r"\A-?\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"
_PARTS = {"year": (YEAR, F.year), "month": (MONTH, F.month), "hour": (HOUR, F.hour)}


def event_time(text: Column, time_format: str = TIME_FORMAT) -> Column:
    """The time written in ``text``, NULL where it does not follow the format (four-digit years).

    The standard format goes through a cast, which costs about half of what the pattern
    formatter costs per row. The cast alone would accept further spellings (a ``T``, fractions of
    a second), so the pattern keeps it to the one format.
    """
    if time_format == TIME_FORMAT:
        return F.when(text.rlike(_TIME_PATTERN), text.try_cast("timestamp_ntz"))
    # A zoned parser would move times that the session zone skips. The sign that separates fields is one no text holds.
    options = {"timestampNTZFormat": time_format, "sep": "\u0001", "quote": "", "escape": ""}
    return F.from_csv(text, "time timestamp_ntz", options)["time"]


def time_fields(text: Column) -> Column:
    """Year, month, day, hour, minute and second as an array of the integers written in ``text``.

    Nothing is checked against the calendar, and a field that is no number is NULL. Use
    ``event_time`` for times; this is for looking at text that is none.
    """
    blanks = F.trim(F.translate(text, "-:", "  "))
    return F.transform(F.split(blanks, " +"), lambda field: field.try_cast("int"))


def time_text(time: Column) -> Column:
    """A zone-less time as text in the standard format, which has whole seconds: fractions go."""
    return F.regexp_replace(time.cast("string"), r"\.\d+\z", "")


def utc_time(time: Column) -> Column:
    """The UTC wall clock of a zoned time, whatever the session zone."""
    seconds = (F.unix_micros(time).cast("decimal(24, 0)") / F.lit(1_000_000)).cast("decimal(18, 6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def with_event_time(
    df: DataFrame, column: str = EVENT_TIME, time_format: str = TIME_FORMAT
) -> DataFrame:
    """Parse the time column in place; zone-less times stay as they are, zoned ones become UTC."""
    kind = df.schema[column].dataType
    if isinstance(kind, TimestampType):
        return df.withColumn(column, utc_time(F.col(column)))
    if not isinstance(kind, StringType):
        return df
    return df.withColumn(column, event_time(F.col(column), time_format))


def with_parts(df: DataFrame, *parts: str, column: str = EVENT_TIME) -> DataFrame:
    """Add ``record_year``, ``record_month`` or ``record_hour`` (integers)."""
    named = {_PARTS[part][0]: _PARTS[part][1](column) for part in parts}
    return df.withColumns(named)
