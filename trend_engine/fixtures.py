"""Post observations, raw items and the serving table, derived from the provided ``events`` table.

Each run of 30 events is one poll (``batch``); four polls in a row observe the same 30 ids, so
upserts have work to do. Everything is a narrow projection of ``events`` (no shuffle), except
``serving``/``stats`` which aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trend_engine.functions.scoring import is_viral_sql, sql_literal, viral_score_sql
from trend_engine.functions.timefmt import ISO_MICROS
from trend_engine.operators.latest import latest_per_key
from trend_engine.schema import TABLE_SCHEMAS, VIRAL_FIELDS

# Fixed values of the derivation: poll size, polls per id group, age step.
POLL_SIZE = 30
IDS_GROUP = 120      # four polls share one set of 30 ids
AGE_STEP_S = 1800    # listed position p is (p mod 24) half-hours old


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Epoch seconds of the (zone-less) event time read as UTC, independent of the session zone.
_OBS_US = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"
_KEYS = [
    f"CAST((event_id div {IDS_GROUP}) * {POLL_SIZE} + event_id % {POLL_SIZE} AS STRING) AS id",
    f"CAST(event_id div {POLL_SIZE} + 1 AS INT) AS batch",
    f"CAST(event_id % {POLL_SIZE} AS INT) AS list_rank",
    f"{_OBS_US} / 1e6D AS obs_s",
    f"timestamp_micros({_OBS_US}) AS observed_at",
    f"CAST(floor({_OBS_US} / 1e6D) AS BIGINT) - CAST(event_id % {POLL_SIZE} % 24 AS BIGINT) * {AGE_STEP_S}"
    " AS unix_time",
]


def posts_from_events(events: DataFrame) -> DataFrame:
    """One row per post observation, with the message fields plus ``list_rank`` and ``observed_at``."""
    base = events.selectExpr(
        *_KEYS,
        "concat(event_type, ' post ', CAST(event_id AS STRING)) AS title",
        "CAST(floor(value * 10) AS INT) AS score",
        "CAST(get_json_object(props, '$.k') AS INT) AS comments",
        "concat('user_', CAST(user_id AS STRING)) AS author",
        "'events' AS source",
        "event_type AS subreddit",
    )
    scored = base.selectExpr(
        "*", f"{viral_score_sql('score', 'comments', 'unix_time', 'obs_s')} AS viral_score")
    return scored.selectExpr(
        "id", "title", "score", "comments", "author", "source", "subreddit", "viral_score",
        f"{is_viral_sql('viral_score')} AS is_viral",
        f"date_format(observed_at, {sql_literal(ISO_MICROS)}) AS timestamp",
        "unix_time", "batch", "list_rank", "observed_at")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts_from_events(read_table(spark, sf_dir, "events"))


def raw_items_from_events(events: DataFrame) -> DataFrame:
    """Raw ranked-list items (before normalising), with missing fields and non-stories mixed in."""
    return events.selectExpr(
        f"(event_id div {IDS_GROUP}) * {POLL_SIZE} + event_id % {POLL_SIZE} AS id",
        "CASE WHEN event_type = 'error' THEN 'job' ELSE 'story' END AS type",
        "CASE WHEN event_id % 17 = 0 THEN '' ELSE concat(event_type, ' post ', CAST(event_id AS STRING)) END AS title",
        "CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(floor(value * 10) AS INT) END AS score",
        "CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(get_json_object(props, '$.k') AS INT) END AS descendants",
        "CASE WHEN event_id % 19 = 0 THEN NULL ELSE concat('user_', CAST(user_id AS STRING)) END AS by",
        "CAST(NULL AS STRING) AS url",
        *[k.replace(" AS unix_time", " AS time") for k in _KEYS if not k.endswith(("AS id", "AS obs_s"))],
    ).select("id", "type", "title", "score", "descendants", "by", "url", "time", "batch", "list_rank",
             "observed_at")


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_items_from_events(read_table(spark, sf_dir, "events"))


def serving_from_posts(p: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Latest viral observation of each id (what the keyed viral-post store holds).

    ``columns`` limits the stored fields carried through the aggregate; the packed struct hides
    unused fields from column pruning, so narrow readers should name what they need.
    """
    values = [c for c in VIRAL_FIELDS[1:] if columns is None or c in columns]
    if "batch_num" not in values:
        values.append("batch_num")
    viral = p.filter("is_viral").selectExpr(
        "id", "title", "score", "comments", "viral_score", "source", "author",
        "observed_at AS timestamp", "batch AS batch_num")
    out = latest_per_key(viral, ["id"], ["batch_num"], values)
    return out if columns is None else out.select("id", *[c for c in values if c in columns])


def stats_from_posts(p: DataFrame) -> DataFrame:
    """Counter rows as the store holds them after the last poll (each poll = one micro-batch,
    epochs numbered from 0, so the last epoch id is the last batch minus one)."""
    from trend_engine.operators.aggregates import batch_counts, last_poll_counts, stat_rows
    per_poll = batch_counts(p, by=["batch"]).selectExpr("*", "batch - 1 AS epoch")
    return stat_rows(last_poll_counts(per_poll, order="batch"))
