"""Job entry points (``spark-submit -m``-style): produce, ingest, topics, hourly, analytics, report, rebuild.

    python -m trend_engine.jobs produce   --items PATH --out PATH [--fmt file|kafka] [--opt k=v ...] [--head N]
                                          [--batch N] [--checkpoint DIR [--once]]
    python -m trend_engine.jobs ingest    --source parquet|file|kafka --path PATH [--opt k=v ...] --store ROOT
                                          --checkpoint DIR [--once] [--raw PATH] [--buckets N]
    python -m trend_engine.jobs topics    (same options as ingest)
    python -m trend_engine.jobs hourly    --raw PATH --out PATH
    python -m trend_engine.jobs analytics --store ROOT --out PATH
    python -m trend_engine.jobs report    --store ROOT --out ROOT
    python -m trend_engine.jobs rebuild   --raw PATH --store ROOT [--buckets N]

The session comes from ``spark-submit``; settings the submitter left unset get
``session.CLUSTER_DEFAULTS`` (UTC zone, AQE with ~256 MB partitions, skew splitting). Nothing row-shaped is collected except ``show()`` of small results.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from trend_engine.operators.aggregates import author_leaderboard, tier_distribution
from trend_engine.operators.views import top_viral_posts
from trend_engine.plans import reports
from trend_engine.plans.produce import messages_from_items, start_producer
from trend_engine.session import apply_cluster_defaults, use_utc
from trend_engine.sources import store
from trend_engine.sources.catalog import observations, raw_posts
from trend_engine.sources.items import LANDED_FIELDS, read_items, with_batch
from trend_engine.sources.messages import publish_posts, read_posts_stream
from trend_engine.sources.outputs import write_analytics, write_report
from trend_engine.sources.rollup import roll_up
from trend_engine.streaming.ingest import start_ingest, start_windowed_topics


def _opts(pairs):
    return dict(p.split("=", 1) for p in pairs or [])


def produce(spark: SparkSession, items: str, out: str | None, fmt: str, opts: dict, head: int | None = None,
            batch: int | None = None, checkpoint: str | None = None, once: bool = False) -> None:
    """Landed items → published messages; ``head`` takes only the first listed of each poll, ``batch``
    numbers the poll of items that carry no number. With a checkpoint, items are taken as they land."""
    rows = read_items(spark, items, stream=checkpoint is not None, extra_fields=LANDED_FIELDS)
    rows = rows if batch is None else with_batch(rows, batch)
    if checkpoint is None:
        publish_posts(messages_from_items(rows, head), fmt, opts, out)
    else:
        start_producer(rows, checkpoint, fmt, opts, out, head, {"availableNow": True} if once else None).awaitTermination()


def ingest(spark: SparkSession, source: str, path: str | None, opts: dict, root: str, checkpoint: str,
           once: bool, topics: bool = False, raw_path: str | None = None, buckets: int = store.BUCKETS) -> None:
    raw = read_posts_stream(spark, source, opts, path)
    trigger = {"availableNow": True} if once else None
    if topics:
        q = start_windowed_topics(raw, root, checkpoint, trigger=trigger)
    else:
        q = start_ingest(raw, root, checkpoint, trigger=trigger, raw_path=raw_path, buckets=buckets)
    q.awaitTermination()


def hourly(spark: SparkSession, raw_path: str, out: str) -> None:
    """Add the raw table's new epochs to the ORC hourly table; only the days they touch are rewritten."""
    roll_up(spark, raw_path, out)


def rebuild(spark: SparkSession, raw_path: str, root: str, buckets: int = store.BUCKETS) -> None:
    """Write the keyed viral table anew from the raw table."""
    store.rebuild_viral(spark, root, observations(raw_posts(spark, raw_path)), buckets)


def analytics(spark: SparkSession, root: str, out: str | None) -> None:
    """The batch analytics run: tier distribution, top posts, author leaderboard, counters, JSON."""
    serving, stats = store.load_serving(spark, root)
    tier_distribution(serving).show(truncate=False)
    top_viral_posts(serving, 5).show(truncate=False)
    author_leaderboard(serving, 5).show(truncate=False)
    reports.stats_listing(stats).show(truncate=False)
    if out:
        write_analytics(reports.analytics_report(serving, stats, now=F.current_timestamp()), out)


def report(spark: SparkSession, root: str, out: str) -> None:
    serving = store.viral_latest(spark, root, reports.TREND_TOP[2])
    write_report(reports.trend_report(serving, store.stats_latest(spark, root), now=F.current_timestamp()), out)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="trend_engine.jobs")
    ap.add_argument("job", choices=["produce", "ingest", "topics", "hourly", "analytics", "report", "rebuild"])
    ap.add_argument("--raw")
    ap.add_argument("--items")
    ap.add_argument("--out")
    ap.add_argument("--fmt", default="file")
    ap.add_argument("--source", default="kafka")
    ap.add_argument("--path")
    ap.add_argument("--opt", action="append")
    ap.add_argument("--store")
    ap.add_argument("--checkpoint")
    ap.add_argument("--head", type=int)
    ap.add_argument("--batch", type=int)
    ap.add_argument("--buckets", type=int, default=store.BUCKETS)
    ap.add_argument("--once", action="store_true")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"trend-engine-{a.job}").getOrCreate()
    apply_cluster_defaults(spark)
    use_utc(spark)
    if a.job == "produce":
        produce(spark, a.items, a.out, a.fmt, _opts(a.opt), a.head, a.batch, a.checkpoint, a.once)
    elif a.job in ("ingest", "topics"):
        ingest(spark, a.source, a.path, _opts(a.opt), a.store, a.checkpoint, a.once, topics=a.job == "topics",
               raw_path=a.raw, buckets=a.buckets)
    elif a.job == "hourly":
        hourly(spark, a.raw, a.out)
    elif a.job == "analytics":
        analytics(spark, a.store, a.out)
    elif a.job == "report":
        report(spark, a.store, a.out)
    else:
        rebuild(spark, a.raw, a.store, a.buckets)


if __name__ == "__main__":
    main()
