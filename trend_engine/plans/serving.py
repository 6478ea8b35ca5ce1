"""Serving reads: the live store, else a saved snapshot, else an empty answer; tagged by ``source``.

A source can fail after its plan was made: a file that cannot be read shows only in a task. So each
candidate is computed and looked at before it is chosen; a response is one row, and that row is what
reaches the driver. Rendering it as JSON is ``to_json(struct(*))`` or ``write.json``.
"""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType, MapType, StringType,
                               StructField, StructType)

from trend_engine.functions.timefmt import iso_local
from trend_engine.plans import reports
from trend_engine.sources import store

LIVE, CACHED, EMPTY = "live", "cached", "empty"

TRENDING_POST = StructType([
    StructField("id", StringType()), StructField("title", StringType()), StructField("score", IntegerType()),
    StructField("comments", IntegerType()), StructField("viral_score", DoubleType()),
    StructField("author", StringType()), StructField("source", StringType())])
TRENDING_BODY = StructType([
    StructField("generated_at", StringType()), StructField("total_viral_posts", LongType()),
    StructField("source", StringType()), StructField("pipeline_stats", MapType(StringType(), StringType())),
    StructField("trending", ArrayType(TRENDING_POST))])
STATS_BODY = StructType([
    StructField("total_viral_posts", LongType()), StructField("total_processed", StringType()),
    StructField("viral_detected", StringType()), StructField("avg_viral_score", DoubleType()),
    StructField("peak_viral_score", DoubleType()), StructField("pipeline_health", StringType()),
    StructField("source", StringType())])
HEALTH_CACHED = "CACHED"


class SourceMissing(Exception):
    """The source has nothing to read."""


def resolve_source(candidates: list[Callable[[], DataFrame]], valid: Callable[[dict], bool]) -> DataFrame:
    """The first candidate that can be computed and is valid (the last one is taken as it is).

    Only errors of Spark and its storage move on to the next candidate; others are raised.
    """
    for build in candidates[:-1]:
        try:
            response = build()
            rows = response.collect()
        except (SourceMissing, PySparkException, Py4JJavaError):
            continue
        if len(rows) == 1 and valid(rows[0].asDict()):
            return _sorted_maps(response.sparkSession.createDataFrame(rows, response.schema))
    return candidates[-1]()


def _sorted_maps(response: DataFrame) -> DataFrame:
    """Map columns in the order of their keys (a row from the driver comes in any order)."""
    return response.select(*[F.map_from_entries(F.array_sort(F.map_entries(f.name))).alias(f.name)
                             if isinstance(f.dataType, MapType) else F.col(f.name) for f in response.schema.fields])


def save_snapshot(response: DataFrame, path: str) -> None:
    """Keep a response as the JSON file that stands in when the store cannot be read."""
    response.coalesce(1).write.mode("overwrite").json(path)


def _snapshot(spark: SparkSession, path: str | None, schema: StructType) -> DataFrame:
    if not path:
        raise SourceMissing
    saved = spark.read.schema(schema).option("multiLine", "true").json(path)
    return saved.withColumn("source", F.lit(CACHED))


def _live_tables(spark: SparkSession, root: str | None, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    if not root or not store.store_exists(spark, root):
        raise SourceMissing
    return store.viral_latest(spark, root, columns), store.stats_latest(spark, root)


def _order(df: DataFrame, schema: StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
                       else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def trending_response(spark: SparkSession, root: str | None, snapshot: str | None = None,
                      now: Column | None = None) -> DataFrame:
    """The board response: the store's counters and 20 best posts, stamped with the time of the call
    (``now`` for another one)."""
    def live():
        serving, stats = _live_tables(spark, root, reports.TRENDING_TOP[2])
        at = F.current_timestamp() if now is None else now
        return _order(reports.trending_payload(serving, stats, LIVE, at), TRENDING_BODY)

    def empty():
        body = spark.range(1).select(
            iso_local(F.current_timestamp()).alias("generated_at"), F.lit(0).cast("bigint").alias("total_viral_posts"),
            F.lit(EMPTY).alias("source"), F.expr("CAST(NULL AS MAP<STRING, STRING>)").alias("pipeline_stats"),
            F.array().cast(ArrayType(TRENDING_POST)).alias("trending"))
        return _order(body, TRENDING_BODY)

    return resolve_source([live, lambda: _order(_snapshot(spark, snapshot, TRENDING_BODY), TRENDING_BODY), empty],
                          lambda r: r["total_viral_posts"] is not None and r["trending"] is not None)


def stats_response(spark: SparkSession, root: str | None, snapshot: str | None = None) -> DataFrame:
    """The figures response: stored posts, counters, average and peak."""
    def live():
        return _order(reports.stats_payload(*_live_tables(spark, root, ["viral_score"]), LIVE), STATS_BODY)

    def empty():
        body = spark.range(1).select(F.lit(0).cast("bigint").alias("total_viral_posts"),
                                     F.lit(HEALTH_CACHED).alias("pipeline_health"), F.lit(EMPTY).alias("source"))
        return _order(body, STATS_BODY)

    return resolve_source([live, lambda: _order(_snapshot(spark, snapshot, STATS_BODY), STATS_BODY), empty],
                          lambda r: r["total_viral_posts"] is not None)
