"""Five-number summaries of the mean day of every country."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmetrics.operators.aggregate import period_means
from gridmetrics.schema import (
    COUNTRY,
    HOUR,
    HOUR_TIMESTAMP,
    METRICS,
    PERCENTILE_ACCURACY,
    QUARTILES,
    SUMMARY_COLUMNS,
    Metric,
)

PROFILE_STEM = "avg_hour_"


def hour_means(
    df: DataFrame, metrics: Sequence[Metric] = METRICS, first_time: str | None = HOUR_TIMESTAMP
) -> DataFrame:
    """Mean of every metric per country and hour of day: at most 25 rows a country (24 and NULL)."""
    return period_means(df, [COUNTRY, HOUR], metrics, PROFILE_STEM, first_time)


def to_long(
    profile: DataFrame, metrics: Sequence[Metric] = METRICS, keys: Sequence[str] = (COUNTRY, HOUR)
) -> DataFrame:
    """One row per key and metric, the metric's tag in ``data`` and its mean in ``value``."""
    tagged = profile.select(
        *keys, *(F.col(f"{PROFILE_STEM}{metric.name}").alias(metric.tag) for metric in metrics)
    )
    return tagged.unpivot(list(keys), [metric.tag for metric in metrics], "data", "value")


def _from_percentile(value: str) -> Column:
    return F.percentile(value, list(QUARTILES))


def _from_sketch(value: str, accuracy: int) -> Column:
    return F.percentile_approx(value, list(QUARTILES), accuracy)


def five_number(
    profile: DataFrame,
    metrics: Sequence[Metric] = METRICS,
    method: str = "exact",
    accuracy: int = PERCENTILE_ACCURACY,
) -> DataFrame:
    """Minimum, quartiles and maximum of the hourly means of every country and metric.

    ``exact`` interpolates between neighbouring means, ``approx`` returns one of the means; the
    methods give different numbers and are never exchanged silently.

    The input is meant to be a profile from ``hour_means``, whose groups are bounded by the hours of
    a day; only the column is checked for.
    Both metrics are unpivoted first, so one scan and one aggregation serve them.
    """
    if HOUR not in profile.columns:
        raise ValueError("five_number takes the hourly means, see hour_means")
    quartiles = {
        "exact": _from_percentile,
        "approx": partial(_from_sketch, accuracy=accuracy),
    }
    if method not in quartiles:
        raise ValueError(f"method must be one of {', '.join(quartiles)}, not {method!r}")
    summary = (
        to_long(profile, metrics)
        .groupBy(COUNTRY, "data")
        .agg(
            F.min("value").alias("min"),
            quartiles[method]("value").alias("quartiles"),
            F.max("value").alias("max"),
        )
    )
    marks = [F.get("quartiles", F.lit(i)) for i in range(len(QUARTILES))]
    values = [F.col("min"), *marks, F.col("max")]
    country, data, *numbers = SUMMARY_COLUMNS
    return summary.select(
        country, data, *(value.alias(name) for value, name in zip(values, numbers, strict=True))
    )
