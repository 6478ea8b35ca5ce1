"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every query reads the provided tables (``events``) in full and derives its input with Spark.
Columns that DuckDB renders differently (timestamps, maps, arrays) are emitted as text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trend_engine import fixtures
from trend_engine.functions.timefmt import hour_label, iso_local, iso_utc, report_key
from trend_engine.operators import aggregates as agg
from trend_engine.operators.board import TRENDING_FIELDS, board, trending_top
from trend_engine.operators.views import top_viral_posts, viral_posts_view
from trend_engine.plans import reports
from trend_engine.plans.produce import messages_from_items
from trend_engine.session import use_utc
from trend_engine.sources.items import head_of_list, normalise_items, with_batch
from trend_engine.sources.messages import envelope, parse_posts

TS_TEXT = "yyyy-MM-dd HH:mm:ss"


def _posts(spark: SparkSession, sf: str) -> DataFrame:
    use_utc(spark)
    return fixtures.posts(spark, sf)


def _serving(spark: SparkSession, sf: str, columns: list[str] | None = None) -> DataFrame:
    return fixtures.serving_from_posts(_posts(spark, sf), columns)


def _both(spark: SparkSession, sf: str, columns: list[str] | None = None):
    p = _posts(spark, sf)
    return fixtures.serving_from_posts(p, columns), fixtures.stats_from_posts(p)


def _items(spark: SparkSession, sf: str) -> DataFrame:
    use_utc(spark)
    return fixtures.raw_items(spark, sf)


def q_viral_score(spark, sf):
    return _posts(spark, sf).select("id", "batch", "score", "comments", "unix_time", "viral_score",
                                    "is_viral")


def q_head_of_list(spark, sf):
    return head_of_list(_items(spark, sf), 5).select("id", "batch", "list_rank", "type", "title")


def q_normalise_items(spark, sf):
    return normalise_items(_items(spark, sf)).select(
        "id", "batch", "title", "score", "comments", "author", "url", "source", "unix_time")


def q_fetch_posts(spark, sf):
    """The hourly job's fetch: first 5 listed per poll, any type with a title."""
    return normalise_items(head_of_list(_items(spark, sf), 5), story_only=False).select(
        "id", "batch", "title", "score", "comments", "author")


def q_score_items(spark, sf):
    """Producer stage: raw items → scored messages."""
    return messages_from_items(_items(spark, sf)).select(
        "id", "batch", "subreddit", "score", "comments", "author", "unix_time", "timestamp", "viral_score",
        "is_viral")


def q_batch_tag(spark, sf):
    """Items of a poller that does not number its polls, numbered on the way in."""
    return with_batch(_items(spark, sf).drop("batch"), 7).select("id", "list_rank", "title", "batch")


def q_assign_topic(spark, sf):
    return normalise_items(_items(spark, sf)).select("id", "batch", F.col("subreddit").alias("topic"))


def q_publish_envelope(spark, sf):
    return envelope(_posts(spark, sf))


def q_parse_posts(spark, sf):
    parsed = parse_posts(envelope(_posts(spark, sf)).select("value"))
    return parsed.select("id", "title", "score", "comments", "author", "source", "subreddit",
                         "viral_score", "is_viral", "timestamp", "unix_time", "batch",
                         iso_utc("observed_at").alias("observed_at"))


def q_viral_posts_view(spark, sf):
    return viral_posts_view(_posts(spark, sf))


def q_tier_distribution(spark, sf):
    return agg.tier_distribution(_posts(spark, sf))


def q_tier_distribution_serving(spark, sf):
    return agg.tier_distribution(_serving(spark, sf, ["viral_score"]))


def q_author_leaderboard(spark, sf):
    return agg.author_leaderboard(_serving(spark, sf, ["author", "viral_score", "score"]), 5)


def q_topic_leaderboard(spark, sf):
    return agg.topic_leaderboard(_posts(spark, sf))


def q_top_viral_posts(spark, sf):
    return top_viral_posts(_serving(spark, sf, ["title", "score", "viral_score"]), 5)


def q_poll_summary(spark, sf):
    return agg.poll_summary(_posts(spark, sf))


def q_hourly_rollup(spark, sf):
    return agg.hourly_rollup(_posts(spark, sf))


def q_windowed_topics(spark, sf):
    w = agg.windowed_topics(_posts(spark, sf), "1 hour")
    return w.withColumn("window_start", F.date_format("window_start", TS_TEXT))


def q_viral_posts_latest(spark, sf):
    s = _serving(spark, sf)
    return s.withColumn("timestamp", iso_utc("timestamp"))


def q_pipeline_stats(spark, sf):
    _, st = _both(spark, sf)
    return st.withColumn("updated_at", iso_utc("updated_at"))


def q_stats_map(spark, sf):
    _, st = _both(spark, sf)
    return reports.stats_listing(st)


def q_stats_summary(spark, sf):
    return reports.stats_payload(*_both(spark, sf, ["viral_score"]))


def q_store_audit(spark, sf):
    return reports.store_audit(*_both(spark, sf, ["viral_score"]))


def q_trending_board(spark, sf):
    return board(_serving(spark, sf, TRENDING_FIELDS))


def q_trending_top20(spark, sf):
    return trending_top(_serving(spark, sf, TRENDING_FIELDS), 20)


def q_trending_payload(spark, sf):
    return reports.as_json_text(reports.trending_payload(*_both(spark, sf, reports.TRENDING_TOP[2])), ["pipeline_stats", "trending"])


def q_trend_report(spark, sf):
    return reports.as_json_text(reports.trend_report(*_both(spark, sf, reports.TREND_TOP[2])), ["pipeline_stats", "top_viral"])


def q_analytics_report(spark, sf):
    return reports.as_json_text(reports.analytics_report(*_both(spark, sf, reports.ANALYTICS_TOP[2])), ["pipeline_stats", "top_posts"])


def q_report_hour(spark, sf):
    p = _posts(spark, sf)
    return p.select("id", "batch", iso_local("observed_at").alias("generated_at"),
                    hour_label("observed_at").alias("hour"), report_key("observed_at").alias("report_hour"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "viral_score": q_viral_score,
    "head_of_list": q_head_of_list,
    "normalise_items": q_normalise_items,
    "fetch_posts": q_fetch_posts,
    "score_items": q_score_items,
    "batch_tag": q_batch_tag,
    "assign_topic": q_assign_topic,
    "publish_envelope": q_publish_envelope,
    "parse_posts": q_parse_posts,
    "viral_posts_view": q_viral_posts_view,
    "tier_distribution": q_tier_distribution,
    "tier_distribution_serving": q_tier_distribution_serving,
    "author_leaderboard": q_author_leaderboard,
    "topic_leaderboard": q_topic_leaderboard,
    "top_viral_posts": q_top_viral_posts,
    "poll_summary": q_poll_summary,
    "hourly_rollup": q_hourly_rollup,
    "windowed_topics": q_windowed_topics,
    "viral_posts_latest": q_viral_posts_latest,
    "pipeline_stats": q_pipeline_stats,
    "stats_map": q_stats_map,
    "stats_summary": q_stats_summary,
    "store_audit": q_store_audit,
    "trending_board": q_trending_board,
    "trending_top20": q_trending_top20,
    "trending_payload": q_trending_payload,
    "trend_report": q_trend_report,
    "analytics_report": q_analytics_report,
    "report_hour": q_report_hour,
}

from trend_engine.plans.stored import STORED  # noqa: E402

QUERIES.update(STORED)
