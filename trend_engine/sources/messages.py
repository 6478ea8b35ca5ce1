"""Post messages: publish (key = id, value = JSON) and read/parse (Kafka, or JSON-lines files).

The Kafka connector is not bundled here; the same code path runs on the file source, whose
``value`` column has the same meaning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trend_engine.functions.timefmt import parse_iso_utc
from trend_engine.schema import ENVELOPE, MESSAGE_FIELDS, POST_MESSAGE, PUBLISHED_FIELDS

# Kafka defaults; the topic is configurable (``subscribe`` / ``topic`` options).
POSTS_TOPIC = "trend_posts"
KAFKA_DEFAULTS = {"subscribe": POSTS_TOPIC, "startingOffsets": "latest"}
JSON_OPTS = {"ignoreNullFields": "false"}


def envelope(posts: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``key`` = id (null when empty), ``value`` = the post as JSON (nulls written as null);
    ``keep`` columns are carried alongside."""
    fields = [F.col(c) if c in posts.columns else F.lit("").alias(c) for c in PUBLISHED_FIELDS]
    key = F.when(F.col("id").isNotNull() & (F.col("id") != F.lit("")), F.col("id"))
    return posts.select(key.alias("key"), F.to_json(F.struct(*fields), JSON_OPTS).alias("value"),
                        *(keep or []))


def publish_posts(posts: DataFrame, fmt: str = "kafka", options: dict | None = None,
                  path: str | None = None) -> None:
    """Write the envelope to Kafka (``kafka.bootstrap.servers`` and ``topic`` in options), or
    as JSON-lines text files (value only) for the file source."""
    env = envelope(posts)
    if fmt == "kafka":
        opts = {"topic": POSTS_TOPIC, **(options or {})}
        env.write.format("kafka").options(**opts).save()
    else:
        env.select("value").write.mode("append").text(path)


def start_publishing(posts: DataFrame, checkpoint: str, fmt: str = "kafka", options: dict | None = None, path: str | None = None,
                     trigger: dict | None = None, name: str = "publish") -> StreamingQuery:
    """The same for a stream of posts; files hold the whole envelope (key and value) as Parquet."""
    env = envelope(posts)
    if fmt == "kafka":
        writer = env.writeStream.format("kafka").options(**{"topic": POSTS_TOPIC, **(options or {})})
    else:
        writer = env.writeStream.format("parquet").option("path", path)
    return writer.queryName(name).option("checkpointLocation", checkpoint).outputMode("append").trigger(
        **(trigger or {"processingTime": "15 seconds"})).start()


def read_posts_stream(spark: SparkSession, fmt: str = "kafka", options: dict | None = None,
                      path: str | None = None) -> DataFrame:
    """Raw message stream with ``value`` (string) and ``partition``/``offset``: from Kafka, from Parquet
    files with Kafka's columns (``parquet``), or from lines of text (``file``, without offsets)."""
    if fmt == "kafka":
        opts = {**KAFKA_DEFAULTS, **(options or {})}
        raw = spark.readStream.format("kafka").options(**opts).load()
        return raw.select(F.col("value").cast("string").alias("value"), "partition", "offset")
    if fmt == "parquet":
        return spark.readStream.schema(ENVELOPE).options(**(options or {})).parquet(path).select("value", "partition", "offset")
    raw = spark.readStream.format("text").options(**(options or {})).load(path)
    return raw.select("value", F.lit(None).cast("int").alias("partition"),
                      F.lit(None).cast("long").alias("offset"))


def parse_posts(raw: DataFrame) -> DataFrame:
    """Bytes/text → JSON → flat message columns; bad JSON gives an all-null row (kept).

    ``url`` is not in the message schema and is dropped. ``observed_at`` is the message time
    as a UTC timestamp. Kafka ``partition``/``offset`` are carried when present.
    """
    carry = [c for c in ("partition", "offset") if c in raw.columns]
    data = F.from_json(F.col("value").cast("string"), POST_MESSAGE)
    parsed = raw.select(data.alias("data"), *carry).select("data.*", *carry)
    return parsed.withColumn("observed_at", parse_iso_utc("timestamp")).select(
        *MESSAGE_FIELDS, "observed_at", *carry)
