"""Grouped statistics of the metrics.

All aggregates here keep a few numbers per group, so Spark combines rows before it shuffles: what
crosses the network is one row per group and task, however large a group is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmetrics.schema import EVENT_TIME, METRICS, Metric
from gridmetrics.sources.readers import union_sources


def period_stats(
    df: DataFrame, keys: Sequence[str], metrics: Sequence[Metric] = METRICS
) -> DataFrame:
    """Mean, minimum and maximum of every metric per key. NULLs are skipped."""
    columns = []
    for metric in metrics:
        columns += [
            F.avg(metric.column).alias(f"avg_{metric.name}"),
            F.min(metric.column).alias(f"min_{metric.name}"),
            F.max(metric.column).alias(f"max_{metric.name}"),
        ]
    return df.groupBy(*keys).agg(*columns)


def period_means(
    df: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[Metric] = METRICS,
    stem: str = "avg_",
    first_time: str | None = None,
) -> DataFrame:
    """Mean of every metric per key, and the first event time present if a name is given for it."""
    columns = [F.avg(metric.column).alias(f"{stem}{metric.name}") for metric in metrics]
    if first_time:
        columns.append(F.min(EVENT_TIME).alias(first_time))
    return df.groupBy(*keys).agg(*columns)


def fold(
    df: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[Metric] = METRICS,
    extremes: bool = True,
    sketch_size: int | None = None,
) -> DataFrame:
    """Accumulators per key: sum and count of every metric, and its minimum and maximum.

    With ``sketch_size`` there is also a KLL sketch of the values, from which quantiles can be read
    (see ``sketched_quartiles``). Its bytes are bounded by the size, however many rows there are.
    Unlike finished means, accumulators of separate loads can be combined; see ``merge_folds``.
    """
    columns = []
    for metric in metrics:
        columns += [
            F.sum(metric.column).alias(f"sum_{metric.name}"),
            F.count(metric.column).alias(f"count_{metric.name}"),
        ]
        if extremes:
            columns += [
                F.min(metric.column).alias(f"min_{metric.name}"),
                F.max(metric.column).alias(f"max_{metric.name}"),
            ]
        if sketch_size:
            value = F.col(metric.column).cast("double")
            number = F.when(~F.isnan(value), value)
            columns.append(F.kll_sketch_agg_double(number, sketch_size).alias(f"sketch_{metric.name}"))
    return df.groupBy(*keys).agg(*columns)


_COMBINE = {"min": F.min, "max": F.max, "sketch": F.kll_merge_agg_double}


def merge_folds(*folds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Combine accumulators made by ``fold`` over disjoint rows."""
    combined = union_sources(*folds)
    columns = []
    for name in combined.columns:
        if name in keys:
            continue
        combine = _COMBINE.get(name.partition("_")[0], F.sum)
        columns.append(combine(name).alias(name))
    return combined.groupBy(*keys).agg(*columns)


def finish_fold(
    folded: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[Metric] = METRICS,
    stem: str = "avg_",
) -> DataFrame:
    """Means, and the extremes if they were kept, from accumulators.

    A group without a single value has no mean (NULL).
    """
    columns = []
    for metric in metrics:
        mean = F.try_divide(f"sum_{metric.name}", f"count_{metric.name}")
        columns.append(mean.alias(f"{stem}{metric.name}"))
        columns += [
            F.col(name)
            for name in (f"min_{metric.name}", f"max_{metric.name}")
            if name in folded.columns
        ]
    return folded.select(*keys, *columns)
