"""The three questions as SQL text over a view of the energy table.

The view holds parsed times; see ``register_energy`` and ``with_event_time``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridmetrics.operators.rank import ranking_orders
from gridmetrics.schema import TOP_K

YEARLY = """
SELECT Country, year(event_time) AS record_year,
       avg(CarbonDirect) AS avg_carbon_intensity,
       min(CarbonDirect) AS min_carbon_intensity,
       max(CarbonDirect) AS max_carbon_intensity,
       avg(CFEpercent) AS avg_cfe_percentage,
       min(CFEpercent) AS min_cfe_percentage,
       max(CFEpercent) AS max_cfe_percentage
FROM {view}
GROUP BY Country, year(event_time)
ORDER BY Country, record_year
"""

MONTHLY = """
SELECT year(event_time) AS record_year, month(event_time) AS record_month,
       avg(CarbonDirect) AS avg_carbon_intensity,
       avg(CFEpercent) AS avg_cfe_percentage
FROM {view}
GROUP BY year(event_time), month(event_time)
"""

RANKING = """
SELECT * FROM {view}
ORDER BY avg_{metric} {way} NULLS LAST, record_year NULLS LAST, record_month NULLS LAST
LIMIT {k}
"""

PROFILE = """
SELECT Country, hour(event_time) AS record_hour,
       avg(CarbonDirect) AS avg_hour_carbon_intensity,
       avg(CFEpercent) AS avg_hour_cfe_percentage
FROM {view}
GROUP BY Country, hour(event_time)
"""

SUMMARY = """
WITH long AS (
  SELECT Country, data, value
  FROM {profile} UNPIVOT INCLUDE NULLS (
    value FOR data IN (
      avg_hour_carbon_intensity AS `carbon-intensity`,
      avg_hour_cfe_percentage AS `cfe`
    )
  )
),
summary AS (
  SELECT Country, data, min(value) AS min,
         percentile(value, array(0.25, 0.5, 0.75)) AS quartiles,
         max(value) AS max
  FROM long
  GROUP BY Country, data
)
SELECT Country, data, min,
       quartiles[0] AS perc_25, quartiles[1] AS perc_50, quartiles[2] AS perc_75, max
FROM summary
ORDER BY Country, data
"""


def yearly_stats_sql(spark: SparkSession, view: str) -> DataFrame:
    return spark.sql(YEARLY.format(view=view))


def monthly_means_sql(spark: SparkSession, view: str) -> DataFrame:
    return spark.sql(MONTHLY.format(view=view))


def ranking_text(name: str, view: str, k: int = TOP_K) -> str:
    metric, _, way = name.rpartition("_")
    return RANKING.format(view=view, metric=metric, way=way.upper(), k=k)


def rankings_sql(spark: SparkSession, view: str, k: int = TOP_K) -> dict[str, DataFrame]:
    """Rankings of a view of monthly means, by the same names as ``rankings``."""
    return {name: spark.sql(ranking_text(name, view, k)) for name in ranking_orders()}


def ranking_board_sql(spark: SparkSession, view: str, k: int = TOP_K) -> DataFrame:
    parts = [
        f"(SELECT '{name}' AS ranking, * FROM ({ranking_text(name, view, k)}))"
        for name in ranking_orders()
    ]
    return spark.sql(" UNION ALL ".join(parts))


def hourly_profile_sql(spark: SparkSession, view: str) -> DataFrame:
    return spark.sql(PROFILE.format(view=view))


def hourly_summary_sql(spark: SparkSession, view: str) -> DataFrame:
    return spark.sql(SUMMARY.format(profile=f"({PROFILE.format(view=view)})"))


def profile_summary_sql(spark: SparkSession, profile_view: str) -> DataFrame:
    """``hourly_summary_sql`` over a view that already holds the hourly means."""
    return spark.sql(SUMMARY.format(profile=profile_view))
