"""Positions of rows in a sorted order, without any task that sees all rows.

Rows are dealt out by range and sorted inside their partitions. A row's position is the number of
rows in the partitions before its own, plus its place there. Only one count per partition and group
is summed up in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmetrics.workspace import stored

# monotonically_increasing_id holds the partition in the upper bits, the place in the lower ones.
_PLACE_BITS = 33


def _columns(df: DataFrame, order: Sequence[str | Column]) -> list[Column]:
    return [df[name] if isinstance(name, str) else name for name in order]


def null_safe_join(
    left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join on equal values of ``names``, NULL equal to NULL; the names come out once, as on the left."""
    other = {name: f"_right_{name}" for name in names}
    right = right.withColumnsRenamed(other)
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(name).eqNullSafe(F.col(other[name]))
    return left.join(right, condition, how).drop(*other.values())


def _dealt_out(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Rows stored in order, with ``_part`` and ``_place``.

    They are written, because a second pass over the plan could draw other range bounds.
    """
    ascending = [F.col(key).asc_nulls_first() for key in keys]
    spread = F.xxhash64(*df.columns)
    wanted = [*ascending, *_columns(df, order), spread.asc()]
    placed = df.repartitionByRange(*wanted).sortWithinPartitions(*wanted)
    placed = stored(placed.withColumn("_at", F.monotonically_increasing_id()), "positions")
    return placed.select(
        *df.columns,
        F.shiftright("_at", _PLACE_BITS).alias("_part"),
        F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias("_place"),
    )


def with_positions(
    df: DataFrame,
    order: Sequence[str | Column],
    keys: Sequence[str] = (),
    position: str = "position",
    size: str = "group_size",
) -> DataFrame:
    """``df`` with the position of each row (from 0) in the order, and the number of rows.

    Both count within the rows of equal ``keys`` (NULL is a key like any other). Rows that the order
    leaves equal follow a hash of all their columns, so a value that many rows share is spread over
    partitions, unless the rows are equal in all columns; count such rows first, see
    ``value_positions``. An empty table gives an empty one.
    """
    rows = _dealt_out(df, keys, order)
    counts = rows.groupBy("_part", *keys).agg(
        F.count("*").alias("_rows"), F.min("_place").alias("_first")
    )
    earlier = Window.partitionBy(F.lit(0), *keys).orderBy("_part")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumns(
        {
            "_before": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)),
            "_size": F.sum("_rows").over(Window.partitionBy(F.lit(0), *keys)),
        }
    )
    joined = null_safe_join(rows, counts, ["_part", *keys])
    return joined.select(
        *df.columns,
        (F.col("_before") + F.col("_place") - F.col("_first")).alias(position),
        F.col("_size").alias(size),
    )


def value_positions(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Each distinct value of every group with its number of rows and the position of the first.

    Equal values are counted before they are sorted, so one that a third of all rows share is one
    row here. Columns: keys, the value, ``n``, ``first_position`` (rows of the group with a lower
    value) and ``group_size``. NULL values are left out.
    """
    counted = (
        df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    )
    rows = _dealt_out(counted, keys, [F.col(value).asc()])
    sums = rows.groupBy("_part", *keys).agg(F.sum("n").alias("_rows"))
    earlier = Window.partitionBy(F.lit(0), *keys).orderBy("_part")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumns(
        {
            "_before": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)),
            "group_size": F.sum("_rows").over(Window.partitionBy(F.lit(0), *keys)),
        }
    )
    inside = Window.partitionBy("_part", *keys).orderBy("_place")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    joined = null_safe_join(rows, sums, ["_part", *keys])
    return joined.select(
        *(*keys, value, "n"),
        (F.col("_before") + F.col("_inside")).alias("first_position"),
        F.col("group_size"),
    )
