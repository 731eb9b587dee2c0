"""The numbered variants of the three questions."""

from __future__ import annotations

from typing import NamedTuple


class Variant(NamedTuple):
    name: str
    question: str
    form: str
    fmt: str
    method: str = "exact"


# Query numbers and names in run time tables.
VARIANTS = {
    1: Variant("Query_1_DF_Parquet", "yearly", "dataframe", "parquet"),
    2: Variant("Query_2_DF_Parquet", "monthly", "dataframe", "parquet"),
    3: Variant("Query_3_DF_Approx_Parquet", "hourly", "dataframe", "parquet", "approx"),
    4: Variant("Query_3_DF_Exact_Parquet", "hourly", "dataframe", "parquet"),
    5: Variant("Query_1_SQL_Parquet", "yearly", "sql", "parquet"),
    6: Variant("Query_2_SQL_Parquet", "monthly", "sql", "parquet"),
    7: Variant("Query_3_SQL_Parquet", "hourly", "sql", "parquet"),
    8: Variant("Query_1_RDD", "yearly", "lines", "csv"),
    9: Variant("Query_2_RDD", "monthly", "lines", "csv"),
    10: Variant("Query_3_RDD", "hourly", "lines", "csv"),
    11: Variant("Query_1_DF_CSV", "yearly", "dataframe", "csv"),
    12: Variant("Query_2_DF_CSV", "monthly", "dataframe", "csv"),
    13: Variant("Query_3_DF_Approx_CSV", "hourly", "dataframe", "csv", "approx"),
    14: Variant("Query_3_DF_Exact_CSV", "hourly", "dataframe", "csv"),
    15: Variant("Query_1_SQL_CSV", "yearly", "sql", "csv"),
    16: Variant("Query_2_SQL_CSV", "monthly", "sql", "csv"),
    17: Variant("Query_3_SQL_CSV", "hourly", "sql", "csv"),
}
