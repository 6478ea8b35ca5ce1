"""The producer stage as a Spark job: ranked-list items → scored post messages.

Per poll: the head of the list is cut first where asked for, non-stories and untitled items are dropped,
defaults are filled, a topic is assigned, and the decay score is computed at the poll's
observation time (``observed_at``), flagged and tagged with the poll number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from trend_engine.functions.scoring import is_viral_sql, sql_literal, viral_score_sql
from trend_engine.functions.timefmt import ISO_MICROS
from trend_engine.sources.items import head_of_list, normalise_items
from trend_engine.sources.messages import start_publishing


def messages_from_items(items: DataFrame, head: int | None = None) -> DataFrame:
    """Message rows (the published fields plus ``observed_at``) from raw items.

    ``head``: posts taken from the head of each poll's ranked list; without it, all of them.
    """
    norm = normalise_items(items if head is None else head_of_list(items, head))
    timed = norm.selectExpr("*", "unix_micros(observed_at) / 1e6D AS obs_s")
    scored = timed.selectExpr("*", f"{viral_score_sql('score', 'comments', 'unix_time', 'obs_s')} AS viral_score")
    return scored.selectExpr(
        "id", "title", "score", "comments", "author", "url", "source", "subreddit",
        f"date_format(observed_at, {sql_literal(ISO_MICROS)}) AS timestamp", "unix_time", "viral_score",
        f"{is_viral_sql('viral_score')} AS is_viral", "batch", "list_rank", "observed_at")


def start_producer(items: DataFrame, checkpoint: str, fmt: str = "kafka", options: dict | None = None, path: str | None = None,
                   head: int | None = None, trigger: dict | None = None, name: str = "post_producer") -> StreamingQuery:
    """The producer stage over a stream of landed items (``read_items(stream=True)``), poll by poll as they
    arrive; ranks, times and poll numbers come with the items."""
    return start_publishing(messages_from_items(items, head), checkpoint, fmt, options, path, trigger, name)
