"""Country labels: Parquet files carry codes, CSV files names written out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmetrics.schema import COUNTRY, COUNTRY_CODES


def canonical_country(df: DataFrame, codes: Mapping[str, str] = COUNTRY_CODES) -> DataFrame:
    """Replace written-out names by codes; labels that are not listed stay as they are."""
    return df.replace(dict(codes), subset=[COUNTRY])


def labels_of(code: str, codes: Mapping[str, str] = COUNTRY_CODES) -> list[str]:
    """All labels of a country."""
    return [code, *(name for name, short in codes.items() if short == code)]


def of_country(
    df: DataFrame, code: str, codes: Mapping[str, str] = COUNTRY_CODES
) -> DataFrame:
    """Rows of one country under any of its labels.

    Apply it before ``canonical_country``: it compares the stored column, so the scan can skip
    row groups that hold other countries.
    """
    return df.filter(F.col(COUNTRY).isin(labels_of(code, codes)))
