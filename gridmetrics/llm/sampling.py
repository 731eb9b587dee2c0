"""A bounded sample for the driver, of which tasks send little more than is taken."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

#: Share by which more rows are asked for than are wanted, so that one pass is nearly always enough.
SPARE = 1.5


def lowest_places(rows: DataFrame, most: int) -> list[Row]:
    """At most ``most`` rows of the lowest ``place``, a 64-bit hash, in order; rows of one place count once.

    A limit on sorted rows would have every task send as many as are wanted. Here the number of rows
    sets a bound on the hash first, so that all tasks together send about what is taken; copies are put
    together before. Where too few places lie below the bound, as many rows share one, it is raised.
    """
    count = rows.count()
    share = 1.0 if count <= most else min(1.0, SPARE * most / count)
    others = F.struct(*(name for name in rows.columns if name != "place"))
    while True:
        bound = int(-(2**63) + share * 2**64)
        below = rows if share >= 1 else rows.where(F.col("place") < F.lit(bound))
        single = below.groupBy("place").agg(F.min(others).alias("_row"))
        taken = single.orderBy("place").limit(most).select("place", "_row.*").collect()
        if len(taken) == most or share >= 1:
            return taken
        share = min(1.0, 4 * share)
