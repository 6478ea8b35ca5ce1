"""Fixed schemas: raw items, post messages and the stored tables.

Fixed values: the field names and types of all of them are wire and table formats.
"""

from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, IntegerType, LongType, MapType, StringType,
                               StructField, StructType, TimestampNTZType, TimestampType)

# The provided event table that the post observations are derived from. Reading with a
# declared schema skips the footer-sampling job that schema inference would run per query.
EVENTS = StructType([
    StructField("event_id", LongType()),
    StructField("ts", TimestampNTZType()),
    StructField("user_id", LongType()),
    StructField("event_type", StringType()),
    StructField("value", DoubleType()),
    StructField("props", StringType()),
])
TABLE_SCHEMAS = {"events": EVENTS}

# A raw item as landed from the ranked story list (one JSON object per line).
RAW_ITEM = StructType([
    StructField("id", LongType()),
    StructField("type", StringType()),
    StructField("title", StringType()),
    StructField("score", IntegerType()),
    StructField("descendants", IntegerType()),
    StructField("by", StringType()),
    StructField("url", StringType()),
    StructField("time", LongType()),
])

# The post message on the wire. ``url`` is published but not part of the parse schema.
POST_MESSAGE = StructType([
    StructField("id", StringType()),
    StructField("title", StringType()),
    StructField("score", IntegerType()),
    StructField("comments", IntegerType()),
    StructField("author", StringType()),
    StructField("source", StringType()),
    StructField("subreddit", StringType()),
    StructField("viral_score", DoubleType()),
    StructField("is_viral", BooleanType()),
    StructField("timestamp", StringType()),
    StructField("unix_time", LongType()),
    StructField("batch", IntegerType()),
])

MESSAGE_FIELDS = [f.name for f in POST_MESSAGE.fields]
PUBLISHED_FIELDS = ["id", "title", "score", "comments", "author", "url", "source", "subreddit",
                    "timestamp", "unix_time", "viral_score", "is_viral", "batch"]

# A message as a topic holds it.
ENVELOPE = StructType([
    StructField("key", StringType()),
    StructField("value", StringType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
])

# Every observation, as the delimited raw table stores it (``batch`` is ``batch_num`` here).
RAW_POSTS = StructType([
    StructField("id", StringType()),
    StructField("title", StringType()),
    StructField("score", IntegerType()),
    StructField("comments", IntegerType()),
    StructField("author", StringType()),
    StructField("source", StringType()),
    StructField("subreddit", StringType()),
    StructField("viral_score", DoubleType()),
    StructField("is_viral", BooleanType()),
    StructField("timestamp", StringType()),
    StructField("unix_time", LongType()),
    StructField("batch_num", IntegerType()),
])

# Latest viral version of each post id.
VIRAL_POSTS = StructType([
    StructField("id", StringType()),
    StructField("title", StringType()),
    StructField("score", IntegerType()),
    StructField("comments", IntegerType()),
    StructField("viral_score", DoubleType()),
    StructField("source", StringType()),
    StructField("author", StringType()),
    StructField("timestamp", TimestampType()),
    StructField("batch_num", IntegerType()),
])
VIRAL_FIELDS = [f.name for f in VIRAL_POSTS.fields]

PIPELINE_STATS = StructType([
    StructField("stat_key", StringType()),
    StructField("stat_value", StringType()),
    StructField("updated_at", TimestampType()),
])

TRENDING_TOPICS = StructType([
    StructField("topic", StringType()),
    StructField("window_start", TimestampType()),
    StructField("post_count", LongType()),
    StructField("avg_score", DoubleType()),
    StructField("avg_viral_score", DoubleType()),
    StructField("total_comments", LongType()),
])

HOURLY_STATS = StructType([
    StructField("hour_bucket", StringType()),
    StructField("total_posts", LongType()),
    StructField("viral_posts", LongType()),
    StructField("avg_viral_score", DoubleType()),
    StructField("top_title", StringType()),
])

_POST = {f.name: f for f in VIRAL_POSTS.fields}
_STATS = StructField("pipeline_stats", MapType(StringType(), StringType()))
ANALYTICS_RESULT = StructType([
    StructField("generated_at", StringType()),
    StructField("total_viral_posts", LongType()),
    _STATS,
    StructField("top_posts", ArrayType(StructType([_POST[c] for c in ("id", "title", "viral_score")]))),
])
REPORT = StructType([
    StructField("generated_at", StringType()),
    StructField("hour", StringType()),
    StructField("total_viral_posts", LongType()),
    _STATS,
    StructField("top_viral", ArrayType(StructType([_POST[c] for c in ("title", "score", "viral_score")]))),
])

# Counter keys written per micro-batch.
STAT_KEYS = ["total_processed", "viral_detected", "last_batch_time"]
