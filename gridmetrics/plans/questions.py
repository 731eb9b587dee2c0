"""The three questions over the energy table, with DataFrame operators.

Every function takes the table as read (text times) or with times already parsed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from gridmetrics.functions import with_event_time, with_parts
from gridmetrics.operators.aggregate import finish_fold, fold, period_means, period_stats
from gridmetrics.operators.summary import five_number, hour_means
from gridmetrics.schema import (
    COUNTRY,
    HOUR,
    MONTH,
    MONTH_TIMESTAMP,
    PERCENTILE_ACCURACY,
    YEAR,
)

YEARLY_KEYS = [COUNTRY, YEAR]
MONTHLY_KEYS = [YEAR, MONTH]
HOURLY_KEYS = [COUNTRY, HOUR]


def yearly_stats(energy: DataFrame) -> DataFrame:
    """Per country and year: mean, minimum and maximum of both metrics, sorted by key."""
    rows = with_parts(with_event_time(energy), "year")
    return period_stats(rows, YEARLY_KEYS).orderBy(*YEARLY_KEYS)


def monthly_means(energy: DataFrame) -> DataFrame:
    """Per year and month: means of both metrics and the first hour present.

    For one country; see ``of_country``.
    """
    rows = with_parts(with_event_time(energy), "year", "month")
    return period_means(rows, MONTHLY_KEYS, first_time=MONTH_TIMESTAMP)


def monthly_timeseries(monthly: DataFrame) -> DataFrame:
    """Monthly means in the order of time."""
    return monthly.orderBy(MONTH_TIMESTAMP, *MONTHLY_KEYS)


def hourly_profile(energy: DataFrame) -> DataFrame:
    """Per country and hour of day: means of both metrics and the first hour present."""
    return hour_means(with_parts(with_event_time(energy), "hour"))


def hourly_summary(
    profile: DataFrame, method: str = "exact", accuracy: int = PERCENTILE_ACCURACY
) -> DataFrame:
    """Five-number summary of the profile per country and metric, sorted."""
    return five_number(profile, method=method, accuracy=accuracy).orderBy(COUNTRY, "data")


def yearly_fold(energy: DataFrame) -> DataFrame:
    """``yearly_stats`` by accumulators."""
    rows = with_parts(with_event_time(energy), "year")
    return finish_fold(fold(rows, YEARLY_KEYS), YEARLY_KEYS).orderBy(*YEARLY_KEYS)


def monthly_fold(energy: DataFrame) -> DataFrame:
    """Monthly means by accumulators."""
    rows = with_parts(with_event_time(energy), "year", "month")
    return finish_fold(fold(rows, MONTHLY_KEYS, extremes=False), MONTHLY_KEYS)


def hourly_fold(energy: DataFrame) -> DataFrame:
    """Hourly means by accumulators."""
    rows = with_parts(with_event_time(energy), "hour")
    return finish_fold(fold(rows, HOURLY_KEYS, extremes=False), HOURLY_KEYS, stem="avg_hour_")
