"""Queries that go through the sinks and sources: stream → store, files, tables and views of the catalog.

Each call works in a fresh directory under the shared root (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trend_engine import fixtures
from trend_engine.functions.timefmt import iso_utc
from trend_engine.operators.aggregates import hourly_rollup
from trend_engine.plans import reports
from trend_engine.plans.produce import start_producer
from trend_engine.plans.serving import save_snapshot, stats_response, trending_response
from trend_engine.session import scratch_dir, use_utc
from trend_engine.sources import catalog, outputs, rollup, store
from trend_engine.sources.items import LANDED_FIELDS, land_items, normalise_items, read_items
from trend_engine.sources.messages import parse_posts, read_posts_stream
from trend_engine.streaming.files import land_envelopes
from trend_engine.streaming.ingest import start_ingest, start_windowed_topics, topics_latest

AVAILABLE_NOW = {"availableNow": True}
#: The replayed stream takes the observations in this many poll ranges, one micro-batch each.
RANGES = 4


def arrival() -> Column:
    """Number of an observation in the order of the polls and their lists."""
    return F.col("batch") * fixtures.POLL_SIZE + F.col("list_rank")


def run_stream(spark: SparkSession, work: str, posts: DataFrame, number: Column, start=start_ingest, raw_path: str | None = None) -> None:
    """Land observations and let the streaming job take what is new (it resumes from its checkpoint)."""
    land_envelopes(posts, f"{work}/input", number)
    resume(spark, work, start, raw_path)


def resume(spark: SparkSession, work: str, start=start_ingest, raw_path: str | None = None) -> None:
    raw = read_posts_stream(spark, fmt="parquet", path=f"{work}/input")
    more = {} if raw_path is None else {"raw_path": raw_path}
    start(raw, f"{work}/store", f"{work}/chk/{start.__name__}", trigger=AVAILABLE_NOW,
          name=f"{start.__name__}_{work[-8:]}", **more).awaitTermination()


def replay_stream(spark: SparkSession, sf: str, start=start_ingest, raw_path: str | None = None) -> str:
    """Stream the observations range by range, the job restarting for each; returns the store's root."""
    use_utc(spark)
    work = scratch_dir(spark, "stream")
    posts = fixtures.posts(spark, sf)
    low, high = posts.agg(F.min("batch"), F.max("batch")).first()
    step = ((high or 0) - (low or 0)) // RANGES + 1
    for k in range(RANGES if low is not None else 0):
        part = posts.where((F.col("batch") >= low + k * step) & (F.col("batch") < low + (k + 1) * step))
        run_stream(spark, work, part, arrival(), start, raw_path)
    return f"{work}/store"


def _viral(spark: SparkSession, root: str) -> DataFrame:
    return store.viral_latest(spark, root).withColumn("timestamp", iso_utc("timestamp"))


def q_stream_viral_latest(spark, sf) -> DataFrame:
    return _viral(spark, replay_stream(spark, sf))


def q_stream_ingest_counts(spark, sf) -> DataFrame:
    root = replay_stream(spark, sf)
    return store.cumulative_counts(spark, root).select("total_processed", "viral_detected")


def q_stream_pipeline_stats(spark, sf) -> DataFrame:
    """Counters left by the last micro-batch (last-batch meaning; the epoch id as last batch)."""
    root = replay_stream(spark, sf)
    return store.stats_latest(spark, root).select("stat_key", "stat_value")


def q_stream_windowed_topics(spark, sf) -> DataFrame:
    root = replay_stream(spark, sf, start_windowed_topics)
    return topics_latest(spark, root).withColumn("window_start",
                                                 F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


def q_stream_restart_order(spark, sf) -> DataFrame:
    """One micro-batch in which the producer restarts: its poll numbers begin again, so only the offsets
    tell which observation of a post is the later one."""
    use_utc(spark)
    work = scratch_dir(spark, "restart")
    posts = fixtures.posts(spark, sf).withColumn("sent", arrival())
    half = (posts.agg(F.max("batch")).first()[0] or 0) // 2
    again = posts.withColumn("batch", F.when(F.col("batch") > half, F.col("batch") - half).otherwise(F.col("batch")))
    run_stream(spark, work, again, F.col("sent"))
    return _viral(spark, f"{work}/store")


def q_rebuilt_viral_latest(spark, sf) -> DataFrame:
    """The keyed table written anew from the raw table that the stream kept."""
    raw = f"{scratch_dir(spark, 'raw')}/raw_posts"
    replay_stream(spark, sf, raw_path=raw)
    root = scratch_dir(spark, "rebuilt")
    store.rebuild_viral(spark, root, catalog.observations(catalog.raw_posts(spark, raw)))
    return _viral(spark, root)


def q_hourly_incremental(spark, sf) -> DataFrame:
    """The hourly table after two increments of the raw table (and a roll-up with nothing new)."""
    use_utc(spark)
    work = scratch_dir(spark, "hourly")
    posts = fixtures.posts(spark, sf)
    half = (posts.agg(F.max("batch")).first()[0] or 0) // 2
    # Odd and even lists within the halves: both increments fall into the same days and hours.
    late = (F.col("batch") > half) | (F.col("list_rank") % 2 == 1)
    for epoch, part in enumerate((posts.where(~late), posts.where(late))):
        catalog.write_raw_epoch(part, f"{work}/raw_posts", "a", epoch)
        rollup.roll_up(spark, f"{work}/raw_posts", f"{work}/hourly_stats")
    rollup.roll_up(spark, f"{work}/raw_posts", f"{work}/hourly_stats")
    return catalog.hourly(spark, f"{work}/hourly_stats")


def q_landed_items(spark, sf) -> DataFrame:
    """Items landed as JSON, read back and normalised."""
    use_utc(spark)
    path = scratch_dir(spark, "items")
    land_items(fixtures.raw_items(spark, sf), path)
    return normalise_items(read_items(spark, path, extra_fields=LANDED_FIELDS)).select(
        "id", "batch", "title", "score", "comments", "author", "url", "source", "unix_time")


def q_stream_score_items(spark, sf) -> DataFrame:
    """Landed items streamed through the producer stage into published messages."""
    use_utc(spark)
    work = scratch_dir(spark, "producer")
    land_items(fixtures.raw_items(spark, sf), f"{work}/items")
    items = read_items(spark, f"{work}/items", stream=True, extra_fields=LANDED_FIELDS)
    start_producer(items, f"{work}/chk", "file", path=f"{work}/messages", trigger=AVAILABLE_NOW,
                   name=f"producer_{work[-8:]}").awaitTermination()
    return parse_posts(spark.read.schema("key string, value string").parquet(f"{work}/messages")).select(
        "id", "batch", "subreddit", "score", "comments", "author", "unix_time", "timestamp", "viral_score", "is_viral")


def q_analytics_file(spark, sf) -> DataFrame:
    """The analytics result as its JSON file holds it."""
    use_utc(spark)
    posts, path = fixtures.posts(spark, sf), scratch_dir(spark, "analytics")
    serving = fixtures.serving_from_posts(posts, reports.ANALYTICS_TOP[2])
    outputs.write_analytics(reports.analytics_report(serving, fixtures.stats_from_posts(posts)), path)
    return reports.as_json_text(outputs.read_analytics(spark, path), ["pipeline_stats", "top_posts"])


def q_report_files(spark, sf) -> DataFrame:
    """The report files after one for the first half of the polls, one for all, and the first written again
    (its first version knew only a quarter)."""
    use_utc(spark)
    posts, root = fixtures.posts(spark, sf), scratch_dir(spark, "reports")
    last = posts.agg(F.max("batch")).first()[0] or 0
    half = posts.where(F.col("batch") <= last // 2)

    def write(observed, counted):
        serving = fixtures.serving_from_posts(observed, reports.TREND_TOP[2])
        outputs.write_report(reports.trend_report(serving, fixtures.stats_from_posts(counted)), root)

    write(posts.where(F.col("batch") <= last // 4), half)
    write(posts, posts)
    write(half, half)
    return reports.as_json_text(outputs.read_reports(spark, root), ["pipeline_stats", "top_viral"])


def _responses(spark, sf, respond, saved, columns) -> DataFrame:
    """The three answers: of a live store, of a store with an unreadable file, and of none at all."""
    use_utc(spark)
    work = scratch_dir(spark, "serving")
    posts = fixtures.posts(spark, sf)
    run_stream(spark, work, posts, arrival())
    save_snapshot(saved(posts), f"{work}/snapshot")
    broken = f"{work}/broken"
    posts.select("title").limit(1).write.text(f"{broken}/{store.VIRAL}/bucket=0")
    out = respond(spark, f"{work}/store", None)
    for root, snapshot in ((broken, f"{work}/snapshot"), (broken, None)):
        out = out.unionByName(respond(spark, root, snapshot))
    return out.select(*columns)


def q_serving_trending(spark, sf) -> DataFrame:
    def saved(posts):
        serving = fixtures.serving_from_posts(posts, reports.TRENDING_TOP[2])
        return reports.trending_payload(serving, fixtures.stats_from_posts(posts))

    out = _responses(spark, sf, trending_response, saved, ["source", "total_viral_posts", "pipeline_stats", "trending"])
    return reports.as_json_text(out, ["pipeline_stats", "trending"])


def q_serving_stats(spark, sf) -> DataFrame:
    def saved(posts):
        return reports.stats_payload(fixtures.serving_from_posts(posts, ["viral_score"]), fixtures.stats_from_posts(posts))

    return _responses(spark, sf, stats_response, saved, [
        "source", "total_viral_posts", "total_processed", "viral_detected", "avg_viral_score", "peak_viral_score", "pipeline_health"])


def _database(spark, sf) -> str:
    """A database of its own, its tables filled by inserts."""
    use_utc(spark)
    root = scratch_dir(spark, "database")
    name = f"trend_{uuid.uuid4().hex[:12]}"
    catalog.create_catalog(spark, name, root)
    posts = fixtures.posts(spark, sf)
    catalog.insert_raw(spark, name, posts)
    catalog.insert_hourly(spark, name, hourly_rollup(posts))
    return name


def q_catalog_topic_leaderboard(spark, sf) -> DataFrame:
    return spark.sql(f"SELECT * FROM {_database(spark, sf)}.topic_leaderboard")


def q_catalog_viral_posts(spark, sf) -> DataFrame:
    return spark.sql(f"SELECT * FROM {_database(spark, sf)}.viral_posts_view")


def q_catalog_hourly(spark, sf) -> DataFrame:
    return spark.sql("SELECT hour_bucket, total_posts, viral_posts, avg_viral_score, top_title "
                     f"FROM {_database(spark, sf)}.hourly_stats")


def _raw_table(spark, sf) -> None:
    use_utc(spark)
    path = f"{scratch_dir(spark, 'raw_posts')}/raw_posts"
    catalog.append_raw_posts(fixtures.posts(spark, sf), path)
    catalog.register(spark, {"raw_posts": catalog.raw_posts(spark, path)})


def q_raw_posts_topic_view(spark, sf) -> DataFrame:
    _raw_table(spark, sf)
    return spark.sql("SELECT * FROM topic_leaderboard")


def q_raw_posts_viral_view(spark, sf) -> DataFrame:
    _raw_table(spark, sf)
    return spark.sql("SELECT * FROM viral_posts_view")


def q_hourly_stats_orc(spark, sf) -> DataFrame:
    use_utc(spark)
    path = f"{scratch_dir(spark, 'hourly')}/hourly_stats"
    catalog.write_hourly(hourly_rollup(fixtures.posts(spark, sf)), path)
    return catalog.hourly(spark, path)


STORED = {
    "stream_viral_latest": q_stream_viral_latest,
    "stream_ingest_counts": q_stream_ingest_counts,
    "stream_windowed_topics": q_stream_windowed_topics,
    "stream_pipeline_stats": q_stream_pipeline_stats,
    "stream_restart_order": q_stream_restart_order,
    "stream_score_items": q_stream_score_items,
    "rebuilt_viral_latest": q_rebuilt_viral_latest,
    "landed_items": q_landed_items,
    "analytics_file": q_analytics_file,
    "report_files": q_report_files,
    "serving_trending": q_serving_trending,
    "serving_stats": q_serving_stats,
    "catalog_topic_leaderboard": q_catalog_topic_leaderboard,
    "catalog_viral_posts": q_catalog_viral_posts,
    "catalog_hourly": q_catalog_hourly,
    "hourly_incremental": q_hourly_incremental,
    "raw_posts_topic_view": q_raw_posts_topic_view,
    "raw_posts_viral_view": q_raw_posts_viral_view,
    "hourly_stats_orc": q_hourly_stats_orc,
}
