"""Structured Streaming jobs: post ingest (viral upserts + counters) and windowed topics.

Both use ``foreachBatch`` with replay-safe merges (see ``sources.keyed``), an explicit
``checkpointLocation`` and ``queryName`` per query, and a 15 s processing-time trigger by
default (``availableNow`` for tests and backfills). Nothing row-shaped reaches the driver:
executors write each micro-batch; the driver sees observed counters and the touched partitions' names.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from trend_engine.operators.aggregates import topic_parts, topics_of_parts
from trend_engine.sources import keyed, store
from trend_engine.sources.messages import parse_posts

#: What a micro-batch adds to a (topic, window): sums and counts, so epochs add up in any order.
TOPIC_PARTS = ["post_count", "scores", "score_sum", "virals", "cents", "total_comments"]
TOPICS_SCHEMA = StructType(
    [StructField("run", StringType()), StructField("topic", StringType()), StructField("window_start", TimestampType())]
    + [StructField(c, LongType()) for c in TOPIC_PARTS]
    + [StructField("upto", LongType()), StructField("day", StringType())])

# Trigger interval and window size.
TRIGGER = {"processingTime": "15 seconds"}
WINDOW = "1 hour"


class _EpochSink:
    """Base ``foreachBatch`` callable: resolves the run id and stamps the ingest time.

    ``skip_empty``: return early on an empty micro-batch (the check stops at the first row).
    ``single_write``: the subclass reads the batch in one action, so it is not cached;
    otherwise the batch is persisted for its several writes and released afterwards.
    """

    skip_empty = True
    single_write = False

    def __init__(self, root: str, checkpoint: str):
        self.root = root.rstrip("/")
        self.checkpoint = checkpoint.rstrip("/")
        self._run = None

    def run_id(self, spark: SparkSession) -> str:
        # The query id lives in the checkpoint's metadata file, written before the first batch;
        # it is stable across restarts and changes only when the checkpoint is lost.
        if self._run is None:
            meta = spark.read.json(f"{self.checkpoint}/metadata").first()
            self._run = "q" + meta["id"].replace("-", "")
        return self._run

    def __call__(self, batch: DataFrame, epoch_id: int) -> None:
        if self.skip_empty and batch.isEmpty():
            return  # empty micro-batch: nothing written, counters unchanged
        spark = batch.sparkSession
        self.now = dt.datetime.now(dt.timezone.utc)
        stamp = F.lit(self.now).cast("timestamp")
        stamped = batch.withColumn("ingested_at", stamp)
        if not self.single_write:
            stamped = stamped.persist()
        try:
            self.write(stamped, self.run_id(spark), int(epoch_id), stamp)
        finally:
            if not self.single_write:
                stamped.unpersist()

    def write(self, batch: DataFrame, run: str, epoch: int, stamp) -> None:
        raise NotImplementedError


class ViralSink(_EpochSink):
    """Viral rows → keyed table (replay-safe); rows without an id → rejects; counters → ledger; optionally
    every observation → the raw table (one directory per epoch, so also replay-safe).

    The counters are observed (``DataFrame.observe``) during the first pass over the batch. Only its
    viral rows are kept for the merge, so without a raw table each micro-batch is read once.
    A batch with no rows writes nothing (the emptiness check is that observed total).
    """

    skip_empty = False

    def __init__(self, root: str, checkpoint: str, raw_path: str | None = None, raw_fmt: str = "csv", buckets: int = store.BUCKETS):
        super().__init__(root, checkpoint)
        self.raw_path, self.raw_fmt, self.buckets = raw_path, raw_fmt, buckets
        self.single_write = raw_path is None

    def write(self, batch, run, epoch, stamp):
        spark = batch.sparkSession
        obs = Observation(f"batch_counts_{run}_{epoch}")
        observed = batch.observe(obs, F.count(F.lit(1)).alias("total"),
                                 F.count_if(F.col("is_viral")).alias("viral"),
                                 F.count_if(F.col("is_viral") & F.col("id").isNull()).alias("rejected"))
        if self.raw_path:
            from trend_engine.sources.catalog import write_raw_epoch
            write_raw_epoch(observed, self.raw_path, run, epoch, self.raw_fmt)  # the full pass
        rows = store.viral_rows(batch if self.raw_path else observed, run, epoch, self.buckets).persist()
        try:
            store.upsert_viral(spark, rows, self.root)  # observe sits before the filter
            counts = obs.get
            if counts["rejected"]:
                store.write_rejects(rows, self.root)
        finally:
            rows.unpersist()
        if counts["total"]:
            store.add_counts(spark, self.root, run, epoch, counts["total"], counts["viral"], counts["rejected"], self.now)


class TopicSink(_EpochSink):
    """What each micro-batch adds per (topic, window) → the topics table, laid out by the window's day.

    Sums are added to those of earlier epochs in place, so the files read do not grow with the epochs;
    rows may be as late as they like, and a replayed epoch adds nothing.
    """

    skip_empty = False
    single_write = True

    def __init__(self, root: str, checkpoint: str, size: str = WINDOW):
        super().__init__(root, checkpoint)
        self.size = size

    def write(self, batch, run, epoch, stamp):
        parts = topic_parts(batch, self.size).select(
            "*", F.date_format("window_start", "yyyy-MM-dd").alias("day"), F.lit(run).alias("run"),
            F.lit(epoch).cast("long").alias("epoch")).persist()
        try:
            keyed.merge_sums(batch.sparkSession, f"{self.root}/{store.TOPICS}", TOPICS_SCHEMA, parts, "day",
                             ["topic", "window_start"], {c: F.sum(c) for c in TOPIC_PARTS})
        finally:
            parts.unpersist()


def _start(df: DataFrame, sink, name: str, checkpoint: str, mode: str, trigger: dict | None) -> StreamingQuery:
    writer = (df.writeStream.queryName(name).option("checkpointLocation", checkpoint)
                .outputMode(mode).foreachBatch(sink))
    return writer.trigger(**(trigger or TRIGGER)).start()


def start_ingest(raw: DataFrame, root: str, checkpoint: str, trigger: dict | None = None,
                 name: str = "post_ingest", raw_path: str | None = None,
                 raw_fmt: str = "csv", buckets: int = store.BUCKETS) -> StreamingQuery:
    """Parse the message stream and upsert viral posts and batch counters per micro-batch
    (and, with ``raw_path``, keep every observation in the raw table)."""
    parsed = parse_posts(raw)
    return _start(parsed, ViralSink(root, checkpoint, raw_path, raw_fmt, buckets), name, checkpoint, "append", trigger)


def start_windowed_topics(raw: DataFrame, root: str, checkpoint: str, trigger: dict | None = None,
                          size: str = WINDOW, name: str = "windowed_topics") -> StreamingQuery:
    """Topic × window sums per micro-batch, added up in the topics table that ``topics_latest`` reads.

    No watermark: late rows count, however late. A row without a time has no window.
    """
    return _start(parse_posts(raw), TopicSink(root, checkpoint, size), name, checkpoint, "append", trigger)


def topics_latest(spark: SparkSession, root: str) -> DataFrame:
    """Every (topic, window_start), newest window first per topic."""
    parts = keyed.read_table(spark, f"{root.rstrip('/')}/{store.TOPICS}", TOPICS_SCHEMA)
    return topics_of_parts(parts).orderBy("topic", F.desc("window_start"))
