from gridmetrics.operators.aggregate import (
    finish_fold,
    fold,
    merge_folds,
    period_means,
    period_stats,
)
from gridmetrics.operators.positions import value_positions, with_positions
from gridmetrics.operators.rank import rank_order, ranking_board, rankings, rankings_by, top_k
from gridmetrics.operators.runs import run_comparison, run_means
from gridmetrics.operators.selection import long_values, row_five_number, row_quantiles
from gridmetrics.operators.sketches import rank_error, sketched_quartiles
from gridmetrics.operators.summary import five_number, hour_means, to_long

__all__ = [
    "finish_fold",
    "five_number",
    "fold",
    "hour_means",
    "long_values",
    "merge_folds",
    "period_means",
    "period_stats",
    "rank_error",
    "rank_order",
    "ranking_board",
    "rankings",
    "rankings_by",
    "row_five_number",
    "row_quantiles",
    "run_comparison",
    "run_means",
    "sketched_quartiles",
    "to_long",
    "top_k",
    "value_positions",
    "with_positions",
]
