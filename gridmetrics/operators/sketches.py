"""Quartiles from stored sketches, without reading rows again.

``fold`` with a sketch size keeps a KLL sketch of each metric beside its sums; ``merge_folds`` merges the
sketches of several loads. What comes out is a value of the input whose rank is near the wanted one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmetrics.schema import METRICS, QUARTILES, Metric

#: Size of a sketch: some 85 kB, and ranks to 0.14 percent (see ``rank_error``).
SKETCH_SIZE = 4000
#: Rank error of a KLL sketch at 99 percent confidence is the first over the size to the second power.
_ERROR_SCALE, _ERROR_POWER = 2.296, 0.9723


def rank_error(sketch_size: int = SKETCH_SIZE) -> float:
    """Share of the rows by which a quantile's rank may be off.

    Twice the error at 99 percent confidence, which is exceeded by less than one quantile in a
    million. Merging does not add to it.
    """
    return 2 * _ERROR_SCALE / sketch_size**_ERROR_POWER


def quantile_of(sketch: str, probability: float) -> Column:
    """A value of rank near ``probability``; NULL for a sketch without values."""
    some = F.kll_sketch_get_n_double(sketch) > 0
    return F.when(some, F.kll_sketch_get_quantile_double(sketch, F.lit(float(probability))))


def sketched_quartiles(
    folded: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[Metric] = METRICS,
    probabilities: Sequence[float] = QUARTILES,
) -> DataFrame:
    """Keys, and per metric ``n_``, ``min_``, ``perc_25_`` and so on and ``max_`` from accumulators with sketches.

    The extremes are exact. A group without values has no quantiles (NULL).
    """
    columns = []
    for metric in metrics:
        columns += [
            F.col(f"count_{metric.name}").alias(f"n_{metric.name}"),
            F.col(f"min_{metric.name}"),
            *(
                quantile_of(f"sketch_{metric.name}", p).alias(f"perc_{round(100 * p)}_{metric.name}")
                for p in probabilities
            ),
            F.col(f"max_{metric.name}"),
        ]
    return folded.select(*keys, *columns)
