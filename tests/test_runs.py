import pytest

from gridmetrics.operators import run_comparison, run_means
from gridmetrics.sinks.runlog import RUN_SCHEMA
from gridmetrics.variants import VARIANTS


@pytest.fixture
def runs(spark):
    def frame(rows):
        return spark.createDataFrame(rows, RUN_SCHEMA)

    return frame


def test_repeated_runs_are_averaged(runs):
    rows = [(1, 1, 2.0), (1, 1, 4.0), (1, 2, 1.0), (10, 1, 8.0), (99, 1, 5.0)]
    found = {(row[0], row[2]): (row[1], row[3]) for row in run_means(runs(rows)).collect()}
    assert found == {
        (1, 1): ("Query_1_DF_Parquet", 3.0),
        (1, 2): ("Query_1_DF_Parquet", 1.0),
        (10, 1): ("Query_3_RDD", 8.0),
        (99, 1): (None, 5.0),
    }


def test_comparison(runs):
    rows = [(number, 1, float(number)) for number in VARIANTS]
    row = run_comparison(runs(rows)).first()
    assert row.parquet_avg == 4.0
    assert row.csv_avg == 14.0
    assert row.dataframe_avg == 7.5
    assert row.sql_avg == 11.0
    assert row.lines_avg == 9.0
    assert row.csv_over_parquet_percent == 250.0


def test_comparison_of_nothing(runs):
    assert set(run_comparison(runs([])).first()) == {None}
    row = run_comparison(runs([(11, 1, 2.0)])).first()
    assert (row.csv_avg, row.csv_over_parquet_percent) == (2.0, None)
