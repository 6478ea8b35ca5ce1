"""Top-k by viral score, ties broken by id.

``orderBy(...).limit(k)`` is planned as TakeOrderedAndProject: every task keeps its own k best
rows and one task merges (tasks × k) rows, so no full sort or shuffle of the input happens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def ranking(by: str = "viral_score", tiebreak: str = "id"):
    return [F.desc_nulls_last(by), F.asc_nulls_last(tiebreak)]


def top_k(df: DataFrame, k: int, by: str = "viral_score", tiebreak: str = "id") -> DataFrame:
    return df.orderBy(*ranking(by, tiebreak)).limit(k)


def with_rank(top: DataFrame, by: str = "viral_score", tiebreak: str = "id",
              name: str = "rank") -> DataFrame:
    """1-based rank over an already-cut top-k (k rows, so one small window partition)."""
    return top.withColumn(name, F.row_number().over(Window.orderBy(*ranking(by, tiebreak))))
