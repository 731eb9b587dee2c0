"""Raw hourly files to the four-column energy table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampType

from gridmetrics.functions.timeparts import (
    event_time,
    time_text,
    utc_time,
    with_event_time,
)
from gridmetrics.schema import COUNTRY, ENERGY_SCHEMA, EVENT_TIME, TIME_FORMAT
from gridmetrics.sources.readers import PLACE, checked_format, read_energy


def to_energy_table(
    df: DataFrame,
    columns: Mapping[str, str] | None = None,
    time_format: str = TIME_FORMAT,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Select, rename and cast raw columns to the energy schema, followed by those in ``keep``.

    ``columns`` maps energy column to raw column; columns left out keep their name. Text that is
    not a number becomes NULL (see ``quarantine`` for an ingest that reports it). Times become text in the standard format, zoned ones in UTC; text
    already in that format passes unread.
    """
    names = {field.name: field.name for field in ENERGY_SCHEMA} | dict(columns or {})
    selected = []
    for field in ENERGY_SCHEMA:
        value = F.col(names[field.name])
        if field.name == EVENT_TIME:
            kind = df.schema[names[field.name]].dataType
            is_text = isinstance(kind, StringType)
            if isinstance(kind, TimestampType):
                value = utc_time(value)
            if is_text and time_format != TIME_FORMAT:
                value = event_time(value, time_format)
            if not is_text or time_format != TIME_FORMAT:
                value = time_text(value)
        else:
            value = value.try_cast(field.dataType)
        selected.append(value.alias(field.name))
    return df.select(*selected, *keep)


def write_energy(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    by_country: bool = False,
    typed: bool = False,
) -> None:
    """Write the energy table, one folder per country if asked.

    With ``typed`` the times are parsed now instead of in every later query.

    With ``by_country`` the rows are first rebalanced by country: small countries end up in few
    files, and adaptive execution splits a country that outgrows a partition over many tasks, so
    one dominant country is never one task's work. The files keep all four columns; the folder
    name repeats the country only for path selection.
    """
    fmt = checked_format(fmt, typed)
    energy = df.select(*ENERGY_SCHEMA.names)
    if typed:
        energy = with_event_time(energy)
    writer = energy.write
    if by_country:
        writer = (
            energy.withColumn(PLACE, F.col(COUNTRY))
            .hint("rebalance", PLACE)
            .write.partitionBy(PLACE)
        )
    writer.mode("overwrite").option("header", "true").format(fmt).save(path)


def write_both_formats(df: DataFrame, base: str) -> dict[str, str]:
    """Write the table as Parquet and as CSV below ``base``; returns the two paths.

    The CSV copy is made from the Parquet one, so the raw input is read and cast once.
    """
    paths = {fmt: f"{base.rstrip('/')}/{fmt}" for fmt in ("parquet", "csv")}
    write_energy(df, paths["parquet"], "parquet")
    written = read_energy(df.sparkSession, paths["parquet"], "parquet")
    write_energy(written, paths["csv"], "csv")
    return paths
