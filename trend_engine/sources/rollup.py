"""The hourly table, rolled up increment by increment from the raw table.

Kept next to the ORC table: ``<out>_parts`` holds mergeable partials per event day, run and hour, and
``<out>_progress`` the last epoch of each run that went in. A roll-up reads only raw epochs after those
(a partition filter), merges their partials into the days they touch and renders just these days anew.
A job that dies anywhere in between can simply be run again: partials know their last epoch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField, StructType)

from trend_engine.operators.aggregates import HOUR_SUMS, hour_parts, hours_of_parts
from trend_engine.sources import catalog, keyed

PARTS = StructType([
    StructField("run", StringType()), StructField("hour_bucket", StringType()),
    *[StructField(c, LongType()) for c in ("total_posts", "viral_posts", "scored", "cents")],
    StructField("best", StructType([StructField("viral_score", DoubleType()), StructField("batch", IntegerType()),
                                    StructField("id", StringType()), StructField("title", StringType())])),
    StructField("upto", LongType()), StructField("day", StringType())])
PROGRESS = StructType([StructField("epoch", LongType()), StructField("run", StringType())])


def new_observations(spark: SparkSession, raw_path: str, out: str, fmt: str = "csv") -> DataFrame:
    """Raw-table rows of the epochs that are not in the roll-up yet, with run and epoch."""
    done = keyed.read_table(spark, f"{out}_progress", PROGRESS).groupBy("run").agg(F.max("epoch").alias("epoch")).collect()
    rows = catalog.observations(catalog.raw_posts(spark, raw_path, fmt, epochs=True))
    if not done:
        return rows
    # One lookup in a literal map: a filter on partition columns alone, so old epochs are not listed or read.
    upto = F.create_map(*[x for r in done for x in (F.lit(r.run), F.lit(r.epoch))])
    return rows.where(F.col("epoch") > F.coalesce(F.element_at(upto, F.col("run")), F.lit(-1).cast("long")))


def roll_up(spark: SparkSession, raw_path: str, out: str, fmt: str = "csv") -> None:
    """Add the new epochs of the raw table to the hourly table (rows without a time have no hour)."""
    out = out.rstrip("/")
    rows = new_observations(spark, raw_path, out, fmt).where("observed_at IS NOT NULL")
    parts = hour_parts(rows, by=["run", "epoch"]).withColumn("day", F.substring("hour_bucket", 1, 10)).persist()
    try:
        keyed.merge_sums(spark, f"{out}_parts", PARTS, parts, "day", ["hour_bucket"], {c: f(c) for c, f in HOUR_SUMS.items()})
        days = [r.day for r in parts.select("day").distinct().collect()]
        if days:
            catalog.write_hourly(hours_of_parts(parts_of_days(spark, out, days)), out)
            keyed.overwrite_partitions(parts.groupBy("run").agg(F.max("epoch").alias("epoch")), f"{out}_progress", "run")
    finally:
        parts.unpersist()


def parts_of_days(spark: SparkSession, out: str, days: list[str]) -> DataFrame:
    return keyed.read_table(spark, f"{out}_parts", PARTS).where(F.col("day").isin(days))
