"""The k highest and lowest periods of a metric.

Each ranking is a sort with a limit, which Spark runs as a bounded top-k: every task keeps k rows
and only those are merged. Nothing is sorted or moved as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmetrics.schema import METRICS, MONTH, TOP_K, YEAR, Metric
from gridmetrics.sources.readers import union_sources

PERIOD = (YEAR, MONTH)


def rank_order(
    value: str, ascending: bool = False, ties: Sequence[str] = PERIOD
) -> list[Column]:
    """Sort order of a ranking: by value with NULLs last, equal values by their keys."""
    column = F.col(value)
    first = column.asc_nulls_last() if ascending else column.desc_nulls_last()
    return [first, *(F.col(tie).asc_nulls_last() for tie in ties)]


def top_k(
    df: DataFrame,
    value: str,
    k: int = TOP_K,
    ascending: bool = False,
    ties: Sequence[str] = PERIOD,
) -> DataFrame:
    """The k rows with the highest (or lowest) value, in order."""
    return df.orderBy(*rank_order(value, ascending, ties)).limit(k)


def ranking_orders(
    metrics: Sequence[Metric] = METRICS, ties: Sequence[str] = PERIOD
) -> dict[str, list[Column]]:
    """Sort orders of the rankings of every metric, both ways, by ranking name."""
    return {
        f"{metric.name}_{way}": rank_order(f"avg_{metric.name}", way == "asc", ties)
        for metric in metrics
        for way in ("desc", "asc")
    }


def rankings(
    df: DataFrame,
    metrics: Sequence[Metric] = METRICS,
    k: int = TOP_K,
    ties: Sequence[str] = PERIOD,
) -> dict[str, DataFrame]:
    """Highest and lowest k rows of every metric, one DataFrame per ranking."""
    orders = ranking_orders(metrics, ties)
    return {name: df.orderBy(*order).limit(k) for name, order in orders.items()}


def ranking_board(
    df: DataFrame,
    metrics: Sequence[Metric] = METRICS,
    k: int = TOP_K,
    ties: Sequence[str] = PERIOD,
) -> DataFrame:
    """All rankings in one table, told apart by a ``ranking`` column.

    The branches share one scan and one aggregation: their plans are equal up to the sort, so
    Spark reuses the shuffled result instead of reading the input once per ranking.
    """
    tagged = [
        ranked.select(F.lit(name).alias("ranking"), "*")
        for name, ranked in rankings(df, metrics, k, ties).items()
    ]
    return union_sources(*tagged)


def rankings_by(
    df: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[Metric] = METRICS,
    k: int = TOP_K,
    ties: Sequence[str] = PERIOD,
) -> DataFrame:
    """Highest and lowest k rows of every metric for every key at once, with ``ranking`` and ``place`` (from 1).

    A row number with a bound lets Spark keep k rows per key in each task before it shuffles, so a
    key's rows never meet, however many they are. NULL is a key like any other. A key with fewer than k rows
    has all of them. The branches share one scan and one aggregation, as in ``ranking_board``.
    """
    tagged = []
    for name, order in ranking_orders(metrics, ties).items():
        placed = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).alias("place")
        ranked = df.select(F.lit(name).alias("ranking"), placed, "*").where(F.col("place") <= k)
        tagged.append(ranked)
    return union_sources(*tagged)
