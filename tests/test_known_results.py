"""Second levels of the monthly and hourly questions on known means."""

import pytest
from expected import (
    APPROX_SUMMARY,
    EXACT_SUMMARY,
    HOURLY_MEANS,
    MONTHLY_CARBON,
    MONTHLY_CFE,
    RANKED_MONTHS,
)

from gridmetrics import plans
from gridmetrics.operators import five_number, ranking_board, rankings
from gridmetrics.sources import register_energy

MONTHS = [(year, month) for year in range(2021, 2025) for month in range(1, 13)]


@pytest.fixture
def hourly_energy(energy_frame):
    """One measurement per country and hour, equal to the known mean."""
    return energy_frame(
        [
            (country, f"2021-01-01 {hour:02d}:00:00", carbon, cfe)
            for country in ("IT", "SE")
            for hour, (carbon, cfe) in enumerate(
                zip(
                    HOURLY_MEANS[country, "carbon-intensity"],
                    HOURLY_MEANS[country, "cfe"],
                    strict=True,
                )
            )
        ]
    )


@pytest.fixture
def monthly_energy(energy_frame):
    return energy_frame(
        [
            ("IT", f"{year}-{month:02d}-01 00:00:00", carbon, cfe)
            for (year, month), carbon, cfe in zip(MONTHS, MONTHLY_CARBON, MONTHLY_CFE, strict=True)
        ]
    )


def _by_key(summary):
    return {(row[0], row[1]): tuple(row[2:]) for row in summary.collect()}


def test_exact_summary(hourly_energy):
    assert _by_key(plans.hourly_summary(plans.hourly_profile(hourly_energy))) == EXACT_SUMMARY


def test_approximate_summary(hourly_energy):
    profile = plans.hourly_profile(hourly_energy)
    assert _by_key(plans.hourly_summary(profile, method="approx")) == APPROX_SUMMARY


def test_sorted_list_summary(hourly_energy):
    found = _by_key(five_number(plans.hourly_fold(hourly_energy), method="exact"))
    assert found.keys() == EXACT_SUMMARY.keys()
    for key, numbers in EXACT_SUMMARY.items():
        assert found[key] == pytest.approx(numbers, rel=1e-14)


def test_sql_summary(spark, hourly_energy):
    from gridmetrics.functions import with_event_time

    register_energy(with_event_time(hourly_energy), "known_hours")
    assert _by_key(plans.hourly_summary_sql(spark, "known_hours")) == EXACT_SUMMARY


def test_rankings(monthly_energy):
    monthly = plans.monthly_means(monthly_energy)
    for name, ranked in rankings(monthly).items():
        rows = ranked.collect()
        assert [(row.record_year, row.record_month) for row in rows] == RANKED_MONTHS[name]
        for row in rows:
            at = MONTHS.index((row.record_year, row.record_month))
            assert row.avg_carbon_intensity == MONTHLY_CARBON[at]
            assert row.avg_cfe_percentage == MONTHLY_CFE[at]
            assert row.month_timestamp.isoformat() == f"{row[0]}-{row[1]:02d}-01T00:00:00"


def test_rankings_sql(spark, monthly_energy):
    register_energy(plans.monthly_means(monthly_energy), "known_months")
    for name, ranked in plans.rankings_sql(spark, "known_months").items():
        keys = [(row.record_year, row.record_month) for row in ranked.collect()]
        assert keys == RANKED_MONTHS[name]


def test_board_holds_every_ranking(monthly_energy):
    rows = ranking_board(plans.monthly_means(monthly_energy)).collect()
    found = {(row.ranking, row.record_year, row.record_month) for row in rows}
    assert len(rows) == 20
    assert found == {(name, *key) for name, keys in RANKED_MONTHS.items() for key in keys}


def test_timeseries_is_in_order(monthly_energy):
    rows = plans.monthly_timeseries(plans.monthly_means(monthly_energy)).collect()
    assert [(row.record_year, row.record_month) for row in rows] == MONTHS
