"""A question from input files to result files, as one Spark job."""

from __future__ import annotations

import argparse
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from gridmetrics.functions import canonical_country, of_country, parse_lines, with_event_time
from gridmetrics.operators.rank import ranking_orders, rankings
from gridmetrics.operators.summary import five_number
from gridmetrics.plans import (
    hourly_fold,
    hourly_profile,
    hourly_profile_sql,
    monthly_fold,
    monthly_means,
    monthly_means_sql,
    profile_summary_sql,
    rankings_sql,
    yearly_fold,
    yearly_stats,
    yearly_stats_sql,
)
from gridmetrics.schema import COUNTRY, HOUR, MONTH, MONTH_TIMESTAMP, YEAR
from gridmetrics.session import energy_session
from gridmetrics.sinks import append_run, kept, write_outputs
from gridmetrics.sources import read_energy, read_lines, register_energy
from gridmetrics.variants import VARIANTS, Variant

RANKED_COUNTRY = "IT"

# The grouped table every result of a question is derived from.
_GROUPED = {
    ("yearly", "dataframe"): yearly_stats,
    ("yearly", "sql"): yearly_stats_sql,
    ("yearly", "lines"): yearly_fold,
    ("monthly", "dataframe"): monthly_means,
    ("monthly", "sql"): monthly_means_sql,
    ("monthly", "lines"): monthly_fold,
    ("hourly", "dataframe"): hourly_profile,
    ("hourly", "sql"): hourly_profile_sql,
    ("hourly", "lines"): hourly_fold,
}


_VIEWS = "gridmetrics_job_"


class OwnViews:
    """Views of one job, under names that no user and no other job has."""

    def __init__(self, spark: SparkSession) -> None:
        self._spark, self._names = spark, []

    def __call__(self, df: DataFrame) -> str:
        name = f"{_VIEWS}{uuid.uuid4().hex}"
        register_energy(df, name)
        self._names.append(name)
        return name

    def drop(self) -> None:
        while self._names:
            self._spark.catalog.dropTempView(self._names.pop())


@contextmanager
def own_views(spark: SparkSession) -> Iterator[OwnViews]:
    """Makes views, and drops exactly those at the end; other jobs of the session keep theirs."""
    views = OwnViews(spark)
    try:
        yield views
    finally:
        views.drop()


def load(
    spark: SparkSession, source: str | Sequence[str], variant: Variant, country: str | None = None
) -> DataFrame:
    """The energy table with parsed times and canonical countries, of one country if given."""
    if variant.form == "lines":
        energy = parse_lines(read_lines(spark, source))
    else:
        energy = with_event_time(read_energy(spark, source, variant.fmt))
    if country is not None:
        energy = of_country(energy, country)
    return canonical_country(energy)


def grouped(
    spark: SparkSession, energy: DataFrame, variant: Variant, view: Callable[[DataFrame], str]
) -> DataFrame:
    build = _GROUPED[variant.question, variant.form]
    if variant.form == "sql":
        return build(spark, view(energy))
    return build(energy)


def results(
    spark: SparkSession, table: DataFrame, variant: Variant, view: Callable[[DataFrame], str]
) -> dict[str, DataFrame]:
    """Results of a question by name, from its grouped table."""
    if variant.question == "yearly":
        return {"stats": table}
    if variant.question == "monthly":
        if variant.form == "sql":
            return rankings_sql(spark, view(table))
        series = {"timeseries": table} if MONTH_TIMESTAMP in table.columns else {}
        return rankings(table) | series
    if variant.form == "sql":
        summary = profile_summary_sql(spark, view(table))
    else:
        summary = five_number(table, method=variant.method)
    return {"summary": summary, "hourly": table}


def result_orders() -> dict[str, Sequence]:
    """How each result is sorted in its files."""
    return {
        "stats": (COUNTRY, YEAR),
        "timeseries": (MONTH_TIMESTAMP, YEAR, MONTH),
        "summary": (COUNTRY, "data"),
        "hourly": (COUNTRY, HOUR),
        **ranking_orders(),
    }


def run(
    spark: SparkSession,
    number: int,
    source: str | Sequence[str],
    target: str,
    workers: int = 1,
    run_log: str | None = None,
    single_file: bool = False,
    country: str = RANKED_COUNTRY,
) -> dict[str, str]:
    """Run one variant, write its results and log its time; returns the result paths.

    The clock covers reading, computing and writing. Results of a question share its grouped
    table, and each is computed once, while it is written. ``country`` is the one the monthly
    question is about. ``single_file`` has one task write each result.
    """
    variant = VARIANTS[number]
    started = time.perf_counter()
    energy = load(spark, source, variant, country if variant.question == "monthly" else None)
    with own_views(spark) as view, kept(grouped(spark, energy, variant, view)) as table:
        outputs = results(spark, table, variant, view)
        base = f"{target.rstrip('/')}/{variant.name.lower()}"
        paths = write_outputs(outputs, base, single_file, result_orders())
        seconds = time.perf_counter() - started
    if run_log is not None:
        append_run(spark, run_log, number, workers, seconds)
    return paths


def main(arguments: Sequence[str] | None = None) -> None:
    names = ", ".join(f"{number} {variant.name}" for number, variant in VARIANTS.items())
    parser = argparse.ArgumentParser(prog="gridmetrics", description=f"Variants: {names}")
    parser.add_argument("variant", type=int, choices=VARIANTS)
    parser.add_argument("source", nargs="+", help="input files or folders")
    parser.add_argument("--target", required=True, help="folder for the results")
    parser.add_argument("--workers", type=int, default=1, help="noted in the run log")
    parser.add_argument("--run-log", help="folder of the run time table")
    parser.add_argument("--country", default=RANKED_COUNTRY, help="of the monthly question")
    parser.add_argument("--single-file", action="store_true", help="one task writes each result")
    options = parser.parse_args(arguments)
    spark = energy_session(f"gridmetrics {VARIANTS[options.variant].name}")
    run(
        spark,
        options.variant,
        options.source,
        options.target,
        options.workers,
        options.run_log,
        options.single_file,
        options.country,
    )
