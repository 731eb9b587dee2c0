"""The clustered layout, the quarantine, rankings by key, and changes between exports."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gridmetrics.operators import rankings_by
from gridmetrics.sinks import key_digests, key_json_changes
from gridmetrics.sources import (
    ingest_checked,
    read_accepted,
    read_clustered,
    read_quarantine,
    write_clustered,
)


def _scanned(df):
    """Rows that the scan handed on, before the filter."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    stack = [plan]
    while stack:
        node = stack.pop()
        if node.nodeName().startswith("Scan parquet"):
            return node.metrics().apply("numOutputRows").value()
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            stack.append(node.executedPlan())
    raise AssertionError("no scan")


@pytest.fixture(scope="module")
def clustered(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("clustered") / "t")
    rows = spark.range(90_000).select(
        # One country has two thirds of the rows; the names leave gaps.
        F.when(F.col("id") % 3 > 0, "BB").otherwise(F.concat(F.lit("C"), (F.col("id") % 30).cast("string"))).alias("Country"),
        F.timestamp_seconds(1_600_000_000 + F.col("id") * 60).cast("timestamp_ntz").cast("string").alias("event_time"),
        F.col("id").cast("double").alias("CarbonDirect"),
        F.lit(50.0).alias("CFEpercent"),
    )
    # So small a table would otherwise end up in one partition.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    write_clustered(rows.repartition(8), path, row_group_bytes=16_384)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return path


def test_rows_of_other_countries_are_not_read(spark, clustered):
    total = read_clustered(spark, clustered)
    assert _scanned(total) == 90_000
    one = read_clustered(spark, clustered, country="C27")
    assert one.count() == 3000
    assert _scanned(read_clustered(spark, clustered, country="C27")) < 15_000
    # Inside the bounds of row groups, but in none of them: the bloom filter.
    assert _scanned(read_clustered(spark, clustered, country="C10")) == 0


def test_rows_of_other_times_are_not_read(spark, clustered):
    since, until = datetime(2020, 9, 20), datetime(2020, 9, 21)
    found = read_clustered(spark, clustered, "BB", since, until)
    assert found.count() == 960
    assert _scanned(read_clustered(spark, clustered, "BB", since, until)) < 20_000
    assert found.agg(F.max("event_time")).first()[0] < until


def test_a_dominant_country_is_spread_over_files(spark, clustered):
    files = read_clustered(spark, clustered, "BB").select(F.input_file_name().alias("f")).distinct().count()
    assert files > 2


def test_nulls_stay_in_the_clustered_layout(spark, tmp_path, energy_frame):
    rows = [(None, None, None, None), ("IT", "2021-01-01 00:00:00", 1.0, None), ("Italy", "bad", 2.0, None)]
    path = str(tmp_path / "t")
    write_clustered(energy_frame(rows), path)
    assert read_clustered(spark, path).count() == 3
    assert read_clustered(spark, path, country="IT").count() == 2
    write_clustered(energy_frame([]), path)
    assert read_clustered(spark, path).collect() == []


def test_rejected_rows_are_counted_and_kept(spark, tmp_path):
    rows = [
        ("IT", "2021-01-01 00:00:00", "1.5", "2"),
        ("IT", "2021-01-01 01:00:00", None, " "),
        ("IT", "2021-13-01 01:00:00", "x1", "2"),
        (" ", None, "1e3", "NaN"),
        (None, "2021-01-01T00:00:00", "1,5", "%"),
    ]
    raw = spark.createDataFrame(rows, "zone string, at string, CarbonDirect string, CFEpercent string").repartition(3)
    path = str(tmp_path / "in")
    report = ingest_checked(raw, path, {"Country": "zone", "event_time": "at"})
    assert (report.rows, report.accepted, report.rejected) == (5, 2, 3)
    assert report.counts == {
        ("Country", "missing"): 2,
        ("event_time", "missing"): 1,
        ("event_time", "unreadable"): 2,
        ("CarbonDirect", "unreadable"): 2,
        ("CFEpercent", "unreadable"): 1,
    }
    kept = sorted(tuple(row) for row in read_accepted(spark, path).collect())
    assert kept[0] == ("IT", "2021-01-01 00:00:00", 1.5, 2.0) and kept[1][2:] == (None, None)
    rejected = read_quarantine(spark, path).collect()
    assert sorted((row.column, row.reason) for row in rejected) == sorted(
        pair for pair, n in report.counts.items() for _ in range(n)
    )
    texts = {(row.column, row.text) for row in rejected}
    assert {("CarbonDirect", "x1"), ("CFEpercent", "%"), ("event_time", "2021-01-01T00:00:00")} <= texts
    assert {row.raw.Country for row in rejected} == {"IT", " ", None}


def test_ingest_of_nothing_and_of_other_time_formats(spark, tmp_path):
    schema = "Country string, event_time string, CarbonDirect string, CFEpercent string"
    path = str(tmp_path / "in")
    report = ingest_checked(spark.createDataFrame([], schema), path)
    assert (report.rows, report.rejected, set(report.counts.values())) == (0, 0, {0})
    assert read_accepted(spark, path).collect() == read_quarantine(spark, path).collect() == []
    rows = [("IT", "01.02.2021 03:04", "1", "1"), ("IT", "2021-02-01 03:04:00", "1", "1")]
    report = ingest_checked(spark.createDataFrame(rows, schema), path, time_format="dd.MM.yyyy HH:mm")
    assert report.counts["event_time", "unreadable"] == 1
    assert read_accepted(spark, path).first().event_time == "2021-02-01 03:04:00"


def test_rankings_of_every_key(spark):
    rows = [
        (country, 2021, month, value, None)
        for country, values in {"IT": [3.0, 1.0, 3.0, None, 5.0, 2.0, 4.0], "SE": [1.0], None: [2.0, 1.0]}.items()
        for month, value in enumerate(values, 1)
    ]
    schema = "Country string, record_year int, record_month int, avg_carbon_intensity double, avg_cfe_percentage double"
    found = rankings_by(spark.createDataFrame(rows, schema).repartition(4), ["Country"]).collect()
    places = {}
    for row in sorted(found, key=lambda row: row.place):
        places.setdefault((row.ranking, row.Country), []).append(row.record_month)
    assert places["carbon_intensity_desc", "IT"] == [5, 7, 1, 3, 6]
    assert places["carbon_intensity_asc", "IT"] == [2, 6, 1, 3, 7]
    assert places["carbon_intensity_desc", "SE"] == [1] and places["carbon_intensity_asc", None] == [2, 1]
    assert places["cfe_percentage_desc", "IT"] == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("digests", [False, True])
def test_changes_between_exports(spark, digests):
    schema = "key string, value string"
    before = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None), (None, "4"), ("e", "5"), ("e", "5"), ("f", None)], schema)
    after = spark.createDataFrame([("a", "1"), ("b", "3"), ("c", "9"), (None, "5"), ("d", "6"), ("f", None)], schema)
    old = key_digests(before) if digests else before
    found = {row.key: (row.change, row.value) for row in key_json_changes(old, after).collect()}
    assert found == {
        "b": ("changed", "3"), "c": ("changed", "9"), None: ("changed", "5"), "d": ("added", "6"), "e": ("dropped", None),
    }
    assert key_json_changes(after, after).collect() == []
    assert {row.change for row in key_json_changes(before.limit(0), after).collect()} == {"added"}
