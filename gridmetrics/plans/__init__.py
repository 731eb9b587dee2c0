from gridmetrics.plans.questions import (
    hourly_fold,
    hourly_profile,
    hourly_summary,
    monthly_fold,
    monthly_means,
    monthly_timeseries,
    yearly_fold,
    yearly_stats,
)
from gridmetrics.plans.sqltext import (
    hourly_profile_sql,
    hourly_summary_sql,
    monthly_means_sql,
    profile_summary_sql,
    ranking_board_sql,
    rankings_sql,
    yearly_stats_sql,
)

__all__ = [
    "hourly_fold",
    "hourly_profile",
    "hourly_profile_sql",
    "hourly_summary",
    "hourly_summary_sql",
    "monthly_fold",
    "monthly_means",
    "monthly_means_sql",
    "monthly_timeseries",
    "profile_summary_sql",
    "ranking_board_sql",
    "rankings_sql",
    "yearly_fold",
    "yearly_stats",
    "yearly_stats_sql",
]
