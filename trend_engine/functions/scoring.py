"""Column functions for scoring, flags, tiers, previews and topics (all JVM built-ins).

Each function takes column names (or SQL expressions) and returns one ``Column`` built from a
single SQL expression, so building a query costs one gateway call per column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The topic list and the viral threshold.
TOPICS = ["technology", "programming", "MachineLearning", "datascience", "artificial", "Python"]
VIRAL_THRESHOLD = 50

# Tier bounds and names, highest first.
TIERS = [
    (100, "MEGA VIRAL (100+)"),
    (75, "HIGH VIRAL (75-100)"),
    (50, "VIRAL (50-75)"),
]
LOWEST_TIER = "TRENDING (<50)"
TIER_LABELS = [
    (100, "🔥 MEGA VIRAL"),
    (75, "⚡ HIGH VIRAL"),
    (50, "📈 VIRAL"),
]
LOWEST_LABEL = "🌱 TRENDING"


def sql_literal(s: str) -> str:
    """A Spark SQL string literal (backslash escapes)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def age_hours_sql(unix_time: str, now_seconds: str) -> str:
    """Age in hours from a unix time to ``now`` (seconds as double), floored at 1 hour."""
    return f"greatest(1.0D, ({now_seconds} - CAST({unix_time} AS DOUBLE)) / 3600.0D)"


def viral_score_sql(score: str, comments: str, unix_time: str, now_seconds: str) -> str:
    """(score + 2·comments) / (max(1, age_h) + 2) ** 1.5, rounded to 2 places.

    Inputs are widened to double first so int scores near 2^31 cannot overflow under ANSI.
    """
    engagement = f"(CAST({score} AS DOUBLE) + CAST({comments} AS DOUBLE) * 2.0D)"
    decay = f"pow({age_hours_sql(unix_time, now_seconds)} + 2.0D, 1.5D)"
    return f"round({engagement} / {decay}, 2)"


def viral_score(score: str, comments: str, unix_time: str, now_seconds: str) -> Column:
    return F.expr(viral_score_sql(score, comments, unix_time, now_seconds))


def is_viral_sql(score: str) -> str:
    """Viral flag on the rounded score, strictly above the threshold."""
    return f"({score} > {VIRAL_THRESHOLD})"


def is_viral(score: str) -> Column:
    return F.expr(is_viral_sql(score))


def _ladder_sql(score: str, bounds, lowest: str) -> str:
    whens = " ".join(f"WHEN {score} >= {b} THEN {sql_literal(name)}" for b, name in bounds)
    return f"CASE {whens} ELSE {sql_literal(lowest)} END"


def tier_sql(score: str) -> str:
    """Tier category; null scores fall to the lowest tier."""
    return _ladder_sql(score, TIERS, LOWEST_TIER)


def tier(score: str) -> Column:
    return F.expr(tier_sql(score))


def tier_label(score: str) -> Column:
    """Short board label with the same bounds as ``tier``."""
    return F.expr(_ladder_sql(score, TIER_LABELS, LOWEST_LABEL))


def preview(title: str, n: int) -> Column:
    """First ``n`` characters of a title."""
    return F.expr(f"substring({title}, 1, {int(n)})")


def topic_bucket_sql(post_id: str) -> str:
    """Deterministic 0..5 bucket from the md5 of the id (first 15 hex digits)."""
    return f"pmod(CAST(conv(substring(md5(CAST({post_id} AS STRING)), 1, 15), 16, 10) AS BIGINT), {len(TOPICS)})"


def assign_topic_sql(post_id: str, given: str | None = None) -> str:
    """The given topic when present, else the hashed bucket's topic."""
    names = ", ".join(sql_literal(t) for t in TOPICS)
    hashed = f"element_at(array({names}), CAST({topic_bucket_sql(post_id)} + 1 AS INT))"
    if given is None:
        return hashed
    return f"CASE WHEN {given} IS NOT NULL AND {given} <> '' THEN {given} ELSE {hashed} END"


def assign_topic(post_id: str, given: str | None = None) -> Column:
    return F.expr(assign_topic_sql(post_id, given))


def cents_sql(score: str) -> str:
    """A two-decimal score as exact integer cents."""
    return f"CAST(round({score} * 100D) AS BIGINT)"


def cents(score: str) -> Column:
    return F.expr(cents_sql(score))
