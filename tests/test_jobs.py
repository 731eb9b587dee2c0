"""All numbered variants from input files to result files."""

import os
import subprocess
import sys
from concurrent.futures import ThreadPoolExecutor

import pytest

from gridmetrics import jobs
from gridmetrics.schema import CSV_HEADER
from gridmetrics.sinks import read_runs
from gridmetrics.sources import write_both_formats
from gridmetrics.variants import VARIANTS

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _measurements():
    for label, base in (("Italy", 300.0), ("SE", 10.0)):
        for year in (2021, 2022):
            for month in range(1, 13):
                for hour in range(24):
                    carbon = base + (month * 7 + hour * 3 + year) % 32 / 4
                    cfe = 50 + (month * 5 + hour + year) % 16 / 8
                    yield label, f"{year}-{month:02d}-03 {hour:02d}:00:00", carbon, cfe


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    from gridmetrics.schema import ENERGY_SCHEMA

    energy = spark.createDataFrame(list(_measurements()), ENERGY_SCHEMA)
    return write_both_formats(energy, str(tmp_path_factory.mktemp("input")))


@pytest.fixture(scope="module")
def outputs(spark, inputs, tmp_path_factory):
    base = tmp_path_factory.mktemp("output")
    paths = {
        number: jobs.run(
            spark, number, inputs[variant.fmt], f"{base}/results", 3, f"{base}/runs", True
        )
        for number, variant in VARIANTS.items()
    }
    return paths, f"{base}/runs"


def _lines(spark, path):
    return [row.value for row in spark.read.text(path).collect()]


def test_every_run_is_logged(spark, outputs):
    rows = read_runs(spark, outputs[1]).collect()
    assert sorted(row.query for row in rows) == sorted(VARIANTS)
    assert {row.workers_number for row in rows} == {3}


@pytest.mark.parametrize("question", ["yearly", "monthly", "hourly"])
def test_variants_of_a_question_agree(spark, outputs, question):
    answers = {}
    for number, variant in VARIANTS.items():
        if variant.question == question:
            for name, path in outputs[0][number].items():
                lines = _lines(spark, path)
                if lines[0].endswith("_timestamp"):
                    lines = [line.rpartition(",")[0] for line in lines]
                answers.setdefault((name, variant.method), []).append(lines)
    for copies in answers.values():
        assert all(copy == copies[0] for copy in copies)
    expected = {
        "yearly": {("stats", "exact"): 5},
        "monthly": {
            **{
                (f"{metric}_{way}", "exact"): 5
                for metric in ("carbon_intensity", "cfe_percentage")
                for way in ("asc", "desc")
            },
            ("timeseries", "exact"): 2,
        },
        "hourly": {
            ("summary", "exact"): 5,
            ("summary", "approx"): 2,
            ("hourly", "exact"): 5,
            ("hourly", "approx"): 2,
        },
    }[question]
    assert {key: len(copies) for key, copies in answers.items()} == expected


def test_labels_are_canonical_and_rows_in_order(spark, outputs):
    keys = [line.split(",")[:2] for line in _lines(spark, outputs[0][1]["stats"])[1:]]
    assert keys == [["IT", "2021"], ["IT", "2022"], ["SE", "2021"], ["SE", "2022"]]
    hours = [line.split(",")[:2] for line in _lines(spark, outputs[0][3]["hourly"])[1:]]
    assert hours == [[country, str(hour)] for country in ("IT", "SE") for hour in range(24)]
    months = [line.split(",")[:2] for line in _lines(spark, outputs[0][2]["timeseries"])[1:]]
    assert months == [[str(y), str(m)] for y in (2021, 2022) for m in range(1, 13)]


def test_rankings_are_of_one_country(spark, outputs):
    for line in _lines(spark, outputs[0][2]["carbon_intensity_desc"])[1:]:
        assert float(line.split(",")[2]) > 200


def test_command_line(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "energy_session", lambda name: spark)
    source = tmp_path / "in.csv"
    source.write_text(f"{CSV_HEADER}\nIT,2021-01-01 00:00:00,1.0,2.0\n")
    jobs.main(["11", str(source), "--target", str(tmp_path / "out"), "--workers", "2",
               "--run-log", str(tmp_path / "log"), "--single-file"])
    found = _lines(spark, str(tmp_path / "out" / "query_1_df_csv" / "stats"))
    assert found[1:] == ["IT,2021,1.0,1.0,1.0,2.0,2.0,2.0"]
    assert read_runs(spark, str(tmp_path / "log")).first().query == 11


def test_jobs_of_one_session_keep_their_views(spark, inputs, tmp_path):
    """The end of a job drops its own views only, also while another one runs."""
    with jobs.own_views(spark) as first:
        name = first(spark.range(3).toDF("n"))
        with jobs.own_views(spark) as second:
            other = second(spark.range(2).toDF("n"))
        assert spark.table(name).count() == 3
        assert not spark.catalog.tableExists(other)
    assert not spark.catalog.tableExists(name)
    with ThreadPoolExecutor(3) as pool:
        runs = [
            pool.submit(jobs.run, spark, number, inputs["parquet"], str(tmp_path / f"t{n}"))
            for n, number in enumerate((5, 6, 7, 7, 6, 5))
        ]
        paths = [run.result() for run in runs]
    for one, again in zip(paths, reversed(paths)):
        for result, path in one.items():
            left, right = (sorted(map(tuple, spark.read.csv(p, header=True).collect())) for p in (path, again[result]))
            assert left == right != []


def test_entry_without_the_libraries_of_the_subpackage():
    code = "import sys; sys.modules['tokenizers'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.LLM_QUERIES))"
    told = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    energy, llm = map(int, told.stdout.split())
    assert energy > 50 and llm == 0
