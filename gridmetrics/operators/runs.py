"""Run time summaries: which variant of a question takes how long."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmetrics.variants import VARIANTS

TIME = "tempo_totale"


def _mean_time(*forms: str, fmt: str | None = None) -> Column:
    wanted = [
        number
        for number, variant in VARIANTS.items()
        if variant.form in forms and fmt in (None, variant.fmt)
    ]
    return F.avg(F.when(F.col("query").isin(wanted), F.col(TIME)))


def run_means(runs: DataFrame) -> DataFrame:
    """Mean time per query and number of workers, with the query's name.

    Names are looked up after grouping, once per group; an unlisted query keeps a NULL name.
    """
    names = F.create_map(
        *(F.lit(part) for number, variant in VARIANTS.items() for part in (number, variant.name))
    )
    means = runs.groupBy("query", "workers_number").agg(F.avg(TIME).alias(TIME))
    name = F.try_element_at(names, F.col("query")).alias("query_name")
    return means.select("query", name, "workers_number", TIME)


def run_comparison(runs: DataFrame) -> DataFrame:
    """One row: mean times by file format and by API, and how much longer CSV takes in percent.

    Formats are compared over the DataFrame and SQL forms, which exist for both. A mean of no runs
    is NULL.
    """
    means = runs.agg(
        _mean_time("dataframe", "sql", fmt="parquet").alias("parquet_avg"),
        _mean_time("dataframe", "sql", fmt="csv").alias("csv_avg"),
        _mean_time("dataframe").alias("dataframe_avg"),
        _mean_time("sql").alias("sql_avg"),
        _mean_time("lines").alias("lines_avg"),
    )
    longer = F.try_divide(F.col("csv_avg") - F.col("parquet_avg"), F.col("parquet_avg")) * 100
    return means.withColumn("csv_over_parquet_percent", longer)
