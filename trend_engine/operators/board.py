"""The trending board: rank, tier label, score texts and bar width over the top 20."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trend_engine.functions.scoring import cents_sql, tier_label
from trend_engine.operators.topk import top_k, with_rank

BOARD_SIZE = 20
TRENDING_FIELDS = ["id", "title", "score", "comments", "viral_score", "author", "source"]


def score_text(score_col: str, places: int):
    """Score shown with 1 or 0 decimals, half-up on its two-decimal value (non-negative)."""
    c = cents_sql(score_col)
    if places == 1:
        return F.expr(f"format_string('%.1f', CAST(({c} + 5) div 10 AS DOUBLE) / 10D)")
    if places == 0:
        return F.expr(f"CAST(({c} + 50) div 100 AS STRING)")
    raise ValueError("places must be 0 or 1")


def trending_top(serving: DataFrame, k: int = BOARD_SIZE) -> DataFrame:
    """Top ``k`` serving rows with the 7 payload fields and their rank."""
    return with_rank(top_k(serving.select(*TRENDING_FIELDS), k))


def board(serving: DataFrame, k: int = BOARD_SIZE) -> DataFrame:
    top = trending_top(serving, k)
    return top.select(
        "rank", "id", "title", tier_label("viral_score").alias("tier_label"),
        score_text("viral_score", 1).alias("score_1dp"), score_text("viral_score", 0).alias("score_0dp"),
        F.least(F.lit(100.0), F.col("viral_score")).alias("bar_width"),
        "author", "score", "comments", "source")
