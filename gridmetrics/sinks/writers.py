"""Result files."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import Column, DataFrame

T = TypeVar("T")

MAX_JOBS = 5
# The times are UTC wall clock, so result files mark them with Z.
TIME_OUTPUT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """A result that is computed for the first of several uses and kept for the others.

    The copy lives on executors and is recomputed from the input where one is lost. A result its
    owner already holds is left to the owner.
    """
    level = df.storageLevel
    if level.useMemory or level.useDisk:
        yield df
        return
    held = df.persist()
    try:
        yield held
    finally:
        held.unpersist()


@contextmanager
def materialised(df: DataFrame) -> Iterator[tuple[DataFrame, int]]:
    """As ``kept``, but computed at once; yields the result with its row count."""
    with kept(df) as held:
        yield held, held.count()


def together(action: Callable[[T], None], items: Iterable[T]) -> None:
    """Run an action on several items at once; the first failure is raised."""
    with ThreadPoolExecutor(MAX_JOBS) as pool:
        list(pool.map(action, items))


def _save(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("header", "true")
        .option("timestampNTZFormat", TIME_OUTPUT)
        .csv(path)
    )


def write_csv(
    df: DataFrame,
    path: str,
    single_file: bool = False,
    order_by: Sequence[str | Column] = (),
    column_names: Sequence[str] = (),
) -> None:
    """Write a result as CSV with headers, replacing what is at ``path``.

    Many tasks write, in order across the files. ``single_file`` has one task write everything,
    whatever its size: it is for small results read by people and plotting tools. There the last
    step is a repartition, not a coalesce: a coalesce would pull the aggregation before it into
    the one writing task.
    """
    result = df.toDF(*column_names) if column_names else df
    if single_file:
        result = result.repartition(1)
        _save(result.sortWithinPartitions(*order_by) if order_by else result, path)
    else:
        _save(result.orderBy(*order_by) if order_by else result, path)


def write_outputs(
    outputs: Mapping[str, DataFrame],
    base: str,
    single_file: bool = False,
    order_by: Mapping[str, Sequence[str | Column]] | None = None,
) -> dict[str, str]:
    """Write several results to sub-folders named after them; returns their paths.

    The results are independent, so their jobs are submitted together.
    """
    paths = {name: f"{base.rstrip('/')}/{name}" for name in outputs}

    def write(name: str) -> None:
        write_csv(outputs[name], paths[name], single_file, (order_by or {}).get(name, ()))

    together(write, outputs)
    return paths
