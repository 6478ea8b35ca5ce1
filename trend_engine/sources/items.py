"""Raw ranked-list items landed as JSON lines: scan, head-of-list cut, normalise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType, TimestampType

from trend_engine.functions.scoring import assign_topic_sql
from trend_engine.schema import RAW_ITEM

# Defaults for missing item fields and the source tag.
DEFAULT_AUTHOR = "unknown"
DEFAULT_URL = ""
SOURCE_TAG = "hackernews"


# Timestamps in landed JSON keep microseconds (the default JSON format stops at milliseconds).
JSON_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


#: What the landing job adds to an item: poll number, place in the ranked list, time of the poll.
LANDED_FIELDS = [StructField("batch", IntegerType()), StructField("list_rank", IntegerType()),
                 StructField("observed_at", TimestampType())]


def land_items(items: DataFrame, path: str) -> None:
    """Append raw items as JSON lines (the landing side of ``read_items``)."""
    items.write.mode("append").option("timestampFormat", JSON_TS_FORMAT).json(path)


def read_items(spark: SparkSession, path: str, stream: bool = False, extra_fields=None) -> DataFrame:
    """JSON-lines items with a fixed schema (no inference). ``extra_fields`` are appended
    (``LANDED_FIELDS``: what the landing job adds)."""
    schema = StructType(list(RAW_ITEM.fields) + list(extra_fields or []))  # a copy: add() mutates
    reader = spark.readStream if stream else spark.read
    return reader.schema(schema).option("timestampFormat", JSON_TS_FORMAT).json(path)


def with_batch(df: DataFrame, n: int) -> DataFrame:
    """Tag every row with the poll number ``n`` (items landed by a poller that does not number its polls)."""
    return df.withColumn("batch", F.lit(int(n)).cast("int"))


def head_of_list(items: DataFrame, n: int, rank_col: str = "list_rank") -> DataFrame:
    """The first ``n`` entries of each poll's ranked list, cut **before** any filtering.

    A positional filter, not ``limit``: ``limit`` is unordered and global, this is per poll.
    """
    return items.filter(F.col(rank_col) < F.lit(n))


def normalise_items(items: DataFrame, now_seconds: str | None = None, story_only: bool = True) -> DataFrame:
    """Keep stories with a non-empty title, rename fields and fill defaults.

    Missing and null fields both get the default (score 0, comments 0, author ``unknown``,
    url ``''``, time = observation time). ``story_only=False`` is the hourly job's variant,
    which does not check the type. ``now_seconds`` is a SQL expression for the fallback time.
    """
    cond = "title IS NOT NULL AND title <> ''" + (" AND type = 'story'" if story_only else "")
    if now_seconds is None:
        now_seconds = ("unix_timestamp(observed_at)" if "observed_at" in items.columns
                       else "unix_timestamp(current_timestamp())")
    keep = [c for c in ("batch", "list_rank", "observed_at") if c in items.columns]
    return items.filter(cond).selectExpr(
        "CAST(id AS STRING) AS id",
        "title",
        "coalesce(score, 0) AS score",
        "coalesce(descendants, 0) AS comments",
        f"coalesce(by, '{DEFAULT_AUTHOR}') AS author",
        f"coalesce(url, '{DEFAULT_URL}') AS url",
        f"'{SOURCE_TAG}' AS source",
        f"{assign_topic_sql('id')} AS subreddit",
        f"coalesce(time, CAST({now_seconds} AS BIGINT)) AS unix_time",
        *keep,
    )
