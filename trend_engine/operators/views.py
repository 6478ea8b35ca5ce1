"""Filter-and-project views over all observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trend_engine.functions.scoring import VIRAL_THRESHOLD, preview
from trend_engine.operators.topk import top_k


VIEW_COLUMNS = ["id", "title", "score", "viral_score", "author", "timestamp"]


def viral_posts_view(raw_posts: DataFrame) -> DataFrame:
    """Observations scoring above the threshold, 6 columns, highest score first.

    The sort is kept for callers that read the view in order; an outer aggregate or top-k
    makes Catalyst drop it. Ties go by id, then observation time, so the range-partitioned sort
    keys are (nearly) unique and one post observed many times at one score cannot pile into a
    single sort task.
    """
    return (raw_posts.filter(F.col("viral_score") > F.lit(VIRAL_THRESHOLD))
                     .select(*VIEW_COLUMNS)
                     .orderBy(F.desc("viral_score"), F.asc("id"), F.asc("timestamp")))


def viral_posts_sql(table: str) -> str:
    """The same as a query text over a table, for a view."""
    return (f"SELECT {', '.join(VIEW_COLUMNS)} FROM {table} WHERE viral_score > {VIRAL_THRESHOLD} "
            "ORDER BY viral_score DESC, id, timestamp")


def top_viral_posts(serving: DataFrame, k: int = 5) -> DataFrame:
    """Top ``k`` stored posts: id, 50-char title preview, raw score, viral score."""
    return top_k(serving, k).select("id", preview("title", 50).alias("title_preview"), "score",
                                   "viral_score")
