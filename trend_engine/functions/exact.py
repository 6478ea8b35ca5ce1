"""Exact averages of two-decimal scores.

Floating sums depend on partitioning and merge order, so two runs (or two engines) can
disagree in the last bit, and ``round(avg, 2)`` can then land on the other side of a
half-cent. These helpers sum exact integer cents instead: the result does not depend on
how Spark splits the data.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _cents_sql(col: str) -> str:
    return f"CAST(round({col} * 100D) AS BIGINT)"


def cents(col: str) -> Column:
    """A two-decimal column as whole cents."""
    return F.expr(_cents_sql(col))


def mean_exact_sql(col: str) -> str:
    """Mean of a two-decimal column: sum of cents / (count · 100), one IEEE division."""
    return f"CAST(sum({_cents_sql(col)}) AS DOUBLE) / CAST(nullif(count({col}), 0) * 100 AS DOUBLE)"


def mean_exact(col: str) -> Column:
    return F.expr(mean_exact_sql(col))


def round2_sql(cents_sum: str, count: str) -> str:
    """A sum of cents over a count, rounded half-up to 2 places (away from zero, for either sign)."""
    n = f"nullif({count}, 0)"
    # ``div`` truncates towards zero, so the magnitude is rounded and the sign put back.
    return f"CAST(sign({cents_sum}) * ((2 * abs({cents_sum}) + {n}) div (2 * {n})) AS DOUBLE) / 100D"


def mean_round2(col: str) -> Column:
    """``round(avg(col), 2)`` with half-up on the exact mean."""
    return F.expr(round2_sql(f"sum({_cents_sql(col)})", f"count({col})"))


def mean_int_sql(col: str) -> str:
    """Mean of an integer column from its exact bigint sum."""
    return f"CAST(sum(CAST({col} AS BIGINT)) AS DOUBLE) / CAST(nullif(count({col}), 0) AS DOUBLE)"


def mean_int(col: str) -> Column:
    return F.expr(mean_int_sql(col))
