"""Readers for the energy table and its raw lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gridmetrics.functions.labels import labels_of
from gridmetrics.schema import COUNTRY_CODES, ENERGY_SCHEMA, TYPED_SCHEMA

PLACE = "place"
FORMATS = ("parquet", "csv")


def _paths(path: str | Sequence[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def _flag(value: bool) -> str:
    return "true" if value else "false"


def checked_format(fmt: str, typed: bool = False) -> str:
    name = fmt.lower()
    if name not in FORMATS:
        raise ValueError(f"format must be one of {', '.join(FORMATS)}, not {fmt!r}")
    if typed and name != "parquet":
        raise ValueError("only parquet files keep typed times")
    return name


def read_energy(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str = "parquet",
    recursive: bool = True,
    typed: bool = False,
) -> DataFrame:
    """The energy table from files or folders, with its declared schema.

    Parquet columns bind by name. CSV columns bind by position whatever their header says; every
    file has one header line. ``event_time`` is text in both (see ``with_event_time``), except in
    Parquet files that ``write_energy`` made with ``typed``.
    """
    fmt = checked_format(fmt, typed)
    schema = TYPED_SCHEMA if typed else ENERGY_SCHEMA
    reader = spark.read.schema(schema).option("recursiveFileLookup", _flag(recursive))
    if fmt == "parquet":
        return reader.parquet(*_paths(path))
    return reader.option("header", "true").option("sep", ",").csv(_paths(path))


def read_lines(
    spark: SparkSession,
    path: str | Sequence[str],
    header: bool | str = True,
    recursive: bool = True,
) -> DataFrame:
    """Text lines as one ``value`` column, without header lines.

    ``header=True`` drops the first line of every file, whatever it says. Lines have no order
    across a cluster, so it cannot be found by counting; the CSV reader knows which split starts a
    file, and with a separator and a quote that text does not contain it hands over whole lines.
    Where the header text is known, passing it is faster: the plain text reader runs and lines
    equal to it are dropped. Blank lines are dropped, as by the CSV reader.
    """
    reader = spark.read.option("recursiveFileLookup", _flag(recursive))
    paths = _paths(path)
    if header is True:
        # A line that holds the separator after all is malformed to the reader, which keeps it whole.
        lines = (
            reader.schema("value string, whole string")
            .option("columnNameOfCorruptRecord", "whole")
            .option("header", "true")
            .option("enforceSchema", "true")
            .option("sep", "\u0001")
            .option("quote", "")
            .option("escape", "")
            .csv(paths)
            .select(F.coalesce("whole", "value").alias("value"))
        )
    else:
        lines = reader.text(paths)
    lines = lines.filter(F.trim("value") != "")
    return lines.filter(lines.value != header) if isinstance(header, str) else lines


def read_countries(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    country: str | None = None,
    codes: Mapping[str, str] = COUNTRY_CODES,
    typed: bool = False,
) -> DataFrame:
    """The table that ``write_energy(..., by_country=True)`` wrote, of one country if given.

    Spark finds the folders below ``path`` itself, so no country is left out, whatever its name.
    With a country, only the folders of its labels are read.
    """
    fmt = checked_format(fmt, typed)
    fields = (TYPED_SCHEMA if typed else ENERGY_SCHEMA).fields
    schema = StructType([*fields, StructField(PLACE, StringType())])
    reader = spark.read.schema(schema).option("basePath", path)
    energy = reader.option("header", "true").format(fmt).load(path)
    if country is not None:
        energy = energy.filter(F.col(PLACE).isin(labels_of(country, codes)))
    return energy.drop(PLACE)


def union_sources(*sources: DataFrame) -> DataFrame:
    """All rows of several sources, matched by column name, duplicates kept."""
    return reduce(DataFrame.unionByName, sources)


def register_energy(df: DataFrame, view: str = "energy_data") -> DataFrame:
    """Make the table visible to SQL text."""
    df.createOrReplaceTempView(view)
    return df
