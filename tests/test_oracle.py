"""Every registered query against the same question asked of DuckDB."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

QUERIES = {name: query for name, query in contract.queries().items() if name not in contract.LLM_QUERIES}
ORACLE = {name: sql for name, sql in contract.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("lineitem", "events"):
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')"
        )
    yield connection
    connection.close()


def _sortable(row):
    return tuple((value is not None, str(type(value)), value) for value in row)


def _normal(rows, names, order):
    picks = [names.index(name) for name in order]
    return sorted((tuple(row[i] for i in picks) for row in rows), key=_sortable)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    ours = [tuple(row) for row in frame.collect()]
    cursor = duck.execute(ORACLE[name])
    columns = [item[0] for item in cursor.description]
    theirs = cursor.fetchall()

    assert sorted(frame.columns) == sorted(columns)
    assert len(ours) == len(theirs) > 0
    order = sorted(columns)
    ours, theirs = _normal(ours, frame.columns, order), _normal(theirs, columns, order)
    for left, right in zip(ours, theirs, strict=True):
        for a, b in zip(left, right, strict=True):
            assert type(a) is type(b)
            assert a == b or (isinstance(a, float) and math.isnan(a) and math.isnan(b))
