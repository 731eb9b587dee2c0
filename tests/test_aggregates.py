import math
import random

import numpy as np
import pytest

from gridmetrics import plans
from gridmetrics.functions import canonical_country, of_country, with_event_time, with_parts
from gridmetrics.operators import (
    finish_fold,
    five_number,
    fold,
    hour_means,
    merge_folds,
    period_stats,
    rankings,
    to_long,
    top_k,
)
from gridmetrics.sources import register_energy

KEYS = ["Country", "record_year"]


def _random_rows(seed, n=4000):
    """Two countries, one with most of the rows; missing values and times among them."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        country = rng.choices(["IT", "SE", None], [8, 2, 1])[0]
        time = (
            f"202{rng.randint(1, 4)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d} "
            f"{rng.randint(0, 23):02d}:00:00"
        )
        rows.append(
            (
                country,
                rng.choice([time] * 20 + ["bad", None]),
                None if rng.random() < 0.1 else rng.randint(0, 400_00) / 128,
                None if rng.random() < 0.1 else rng.randint(0, 100_00) / 128,
            )
        )
    return rows


def _rows(frame):
    return sorted(map(tuple, frame.collect()), key=lambda row: [(x is not None, x) for x in row])


def _expected_stats(rows):
    groups = {}
    for country, time, *values in rows:
        year = int(time[:4]) if time and time != "bad" else None
        groups.setdefault((country, year), []).append(values)
    result = {}
    for key, members in groups.items():
        line = []
        for i in range(2):
            present = [values[i] for values in members if values[i] is not None]
            line += [sum(present) / len(present), min(present), max(present)]
        result[key] = tuple(line)
    return result


# The metrics are multiples of 1/128, whose sums are exact in any order.
@pytest.mark.parametrize("seed", [1, 2])
def test_all_forms_of_yearly_stats_agree(spark, energy_frame, seed):
    rows = _random_rows(seed)
    energy = energy_frame(rows).repartition(8)
    expected = _expected_stats(rows)
    register_energy(with_event_time(energy), "random_energy")
    for frame in (
        plans.yearly_stats(energy),
        plans.yearly_stats_sql(spark, "random_energy"),
        plans.yearly_fold(energy),
    ):
        found = frame.collect()
        assert {(row[0], row[1]): tuple(row[2:]) for row in found} == expected
        assert len(found) == len(expected)
        keys = [(row[0] is not None, row[0] or "", row[1] or 0) for row in found]
        assert keys == sorted(keys)


@pytest.mark.parametrize("seed", [3])
def test_all_forms_of_monthly_means_agree(spark, energy_frame, seed):
    energy = of_country(energy_frame(_random_rows(seed)), "IT").repartition(8)
    register_energy(with_event_time(energy), "random_month")
    by_frame = _rows(plans.monthly_means(energy).drop("month_timestamp"))
    assert by_frame == _rows(plans.monthly_means_sql(spark, "random_month"))
    assert by_frame == _rows(plans.monthly_fold(energy))


@pytest.mark.parametrize("seed", [4])
def test_all_forms_of_the_day_profile_agree(spark, energy_frame, seed):
    energy = energy_frame(_random_rows(seed)).repartition(8)
    register_energy(with_event_time(energy), "random_hour")
    by_frame = _rows(plans.hourly_profile(energy).drop("hour_timestamp"))
    assert by_frame == _rows(plans.hourly_profile_sql(spark, "random_hour"))
    assert by_frame == _rows(plans.hourly_fold(energy))
    exact = _rows(plans.hourly_summary(plans.hourly_profile(energy)))
    assert exact == _rows(plans.hourly_summary_sql(spark, "random_hour"))
    listed = _rows(five_number(plans.hourly_fold(energy), method="exact"))
    for left, right in zip(exact, listed, strict=True):
        assert left[:2] == right[:2]
        assert left[2:] == pytest.approx(right[2:], rel=1e-12)


@pytest.mark.parametrize("seed", [7, 8])
def test_summary_against_brute_force(energy_frame, seed):
    rows = _random_rows(seed, 1500)
    hours = {}
    for country, time, *values in rows:
        hour = int(time[11:13]) if time and time != "bad" else None
        for tag, value in zip(("carbon-intensity", "cfe"), values, strict=True):
            if value is not None:
                hours.setdefault((country, tag), {}).setdefault(hour, []).append(value)
    profile = plans.hourly_profile(energy_frame(rows).repartition(8))
    exact, approx = (
        {tuple(row[:2]): row[2:] for row in plans.hourly_summary(profile, method=m).collect()}
        for m in ("exact", "approx")
    )
    assert exact.keys() == approx.keys() == hours.keys()
    for key, groups in hours.items():
        means = sorted(sum(values) / len(values) for values in groups.values())
        expected = np.percentile(means, [0, 25, 50, 75, 100])
        assert exact[key] == pytest.approx(tuple(expected), rel=1e-12)
        picks = [means[math.ceil(p * len(means)) - 1] for p in (0.25, 0.5, 0.75)]
        assert list(approx[key]) == [means[0], *picks, means[-1]]


def test_folds_of_parts_merge_to_the_whole(energy_frame):
    rows = _random_rows(6)
    parts = [
        fold(with_parts(with_event_time(energy_frame(rows[i::3])), "year"), KEYS) for i in range(3)
    ]
    merged = finish_fold(merge_folds(*parts, keys=KEYS), KEYS)
    assert _rows(merged) == _rows(plans.yearly_fold(energy_frame(rows)))


def test_group_without_values_has_null_results(energy_frame):
    rows = [("IT", "2021-01-01 00:00:00", None, None)] * 2
    for frame in (plans.yearly_stats(energy_frame(rows)), plans.yearly_fold(energy_frame(rows))):
        assert _rows(frame) == [("IT", 2021, *[None] * 6)]


def test_empty_input_keeps_the_schema(energy_frame):
    energy = energy_frame([])
    full = energy_frame([("IT", "2021-01-01 00:00:00", 1.0, 2.0)])
    empty = plans.yearly_stats(energy)
    assert empty.collect() == []
    assert empty.schema == plans.yearly_stats(full).schema
    for method in ("exact", "approx"):
        summary = plans.hourly_summary(plans.hourly_profile(energy), method=method)
        assert summary.collect() == []
        assert [kind for _, kind in summary.dtypes] == ["string"] * 2 + ["double"] * 5


def test_bad_times_form_their_own_group(energy_frame):
    rows = [("IT", "bad", 1.0, 2.0), ("IT", None, 3.0, 4.0)]
    rows.append(("IT", "2021-01-01 00:00:00", 9.0, 9.0))
    found = {row.record_year: row for row in plans.yearly_stats(energy_frame(rows)).collect()}
    assert found[None].avg_carbon_intensity == 2.0
    assert found[2021].avg_carbon_intensity == 9.0


def test_one_hour_gives_five_equal_numbers(energy_frame):
    profile = plans.hourly_profile(energy_frame([("IT", "2021-01-01 05:00:00", 7.5, 80.0)]))
    for method in ("exact", "approx"):
        rows = plans.hourly_summary(profile, method=method).collect()
        assert [tuple(row) for row in rows] == [
            ("IT", "carbon-intensity", *[7.5] * 5),
            ("IT", "cfe", *[80.0] * 5),
        ]


def test_country_without_values_is_kept_in_the_summary(energy_frame):
    profile = plans.hourly_profile(energy_frame([("IT", "2021-01-01 05:00:00", None, 80.0)]))
    for method in ("exact", "approx"):
        carbon = plans.hourly_summary(profile, method=method).first()
        assert tuple(carbon) == ("IT", "carbon-intensity", *[None] * 5)


def test_hours_weigh_days_equally_and_quartiles_weigh_hours_equally(energy_frame):
    rows = [("IT", f"2021-01-{day:02d} 00:00:00", 10.0, 1.0) for day in range(1, 29)]
    rows += [("IT", "2021-01-01 01:00:00", 20.0, 1.0), ("IT", "2021-01-01 02:00:00", 30.0, 1.0)]
    summary = plans.hourly_summary(plans.hourly_profile(energy_frame(rows))).first()
    assert tuple(summary)[2:] == (10.0, 15.0, 20.0, 25.0, 30.0)


def test_summary_takes_only_profiles(energy_frame):
    with pytest.raises(ValueError, match="hour_means"):
        five_number(energy_frame([]))
    with pytest.raises(ValueError, match="method"):
        five_number(plans.hourly_profile(energy_frame([])), method="exactly")


def test_first_time_is_the_first_present(energy_frame):
    rows = [("IT", "2021-03-05 07:00:00", 1.0, 1.0), ("IT", "2021-03-04 09:00:00", 1.0, 1.0)]
    assert plans.monthly_means(energy_frame(rows)).first().month_timestamp.day == 4
    means = hour_means(with_parts(with_event_time(energy_frame(rows)), "hour"), first_time=None)
    assert "hour_timestamp" not in means.columns


def test_long_form_keeps_every_value(energy_frame):
    rows = [("IT", "2021-01-01 05:00:00", None, 80.0)]
    assert _rows(to_long(plans.hourly_profile(energy_frame(rows)))) == [
        ("IT", 5, "carbon-intensity", None),
        ("IT", 5, "cfe", 80.0),
    ]


def _months(energy_frame, values):
    rows = [("IT", f"2021-{i:02d}-01 00:00:00", v, v) for i, v in enumerate(values, start=1)]
    return plans.monthly_means(energy_frame(rows))


def _ranked_months(monthly):
    return {
        name: [row.record_month for row in df.collect()] for name, df in rankings(monthly).items()
    }


def test_ties_go_to_the_earlier_month(energy_frame):
    monthly = _months(energy_frame, [5.0, 7.0, 7.0, 5.0, 7.0])
    highest = top_k(monthly, "avg_carbon_intensity", 2).collect()
    lowest = top_k(monthly, "avg_carbon_intensity", 2, ascending=True).collect()
    assert [row.record_month for row in highest] == [2, 3]
    assert [row.record_month for row in lowest] == [1, 4]


def test_nulls_rank_last_both_ways(energy_frame):
    monthly = _months(energy_frame, [None, 2.0, 1.0])
    found = _ranked_months(monthly)
    assert found["carbon_intensity_desc"] == [2, 3, 1]
    assert found["carbon_intensity_asc"] == [3, 2, 1]


def test_nan_is_the_highest_number_in_both_directions(energy_frame):
    monthly = _months(energy_frame, [1.0, math.nan, 2.0])
    found = _ranked_months(monthly)
    assert found["carbon_intensity_desc"] == [2, 3, 1]
    assert found["carbon_intensity_asc"] == [1, 3, 2]


def test_labels(energy_frame):
    rows = [(c, "2021-01-01 00:00:00", 1.0, 1.0) for c in ("IT", "Italy", "FR", None, "Sweden")]
    found = [row.Country for row in canonical_country(energy_frame(rows)).collect()]
    assert found == ["IT", "IT", "FR", None, "SE"]
    assert of_country(energy_frame(rows), "IT").count() == 2
    assert of_country(energy_frame(rows), "FR").count() == 1


def test_other_metrics(spark):
    from gridmetrics.schema import Metric

    frame = spark.createDataFrame([("a", 1.0), ("a", 3.0)], "k string, x double")
    row = period_stats(frame, ["k"], [Metric("x", "load", "load")]).first()
    assert row.asDict() == {"k": "a", "avg_load": 2.0, "min_load": 1.0, "max_load": 3.0}
