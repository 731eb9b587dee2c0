"""The registered query that ingests a renamed raw table in another time format."""

import os

import __spark_entry__ as contract

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def test_renamed_raw_table_is_profiled_like_the_events(spark):
    queries = contract.queries()
    found = queries["renamed_raw_table"](spark, SF_DIR).collect()
    assert found and all(row[1] is not None for row in found)
    profile = queries["hourly_profile"](spark, SF_DIR).collect()  # whose times keep fractions of seconds
    assert {row[:4] for row in found} == {row[:4] for row in profile}
    assert "renamed_raw_table" in contract.oracle_sql()
