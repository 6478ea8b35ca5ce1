"""Result files: the analytics JSON, the saved response and the hourly report files keyed by New York hour."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from trend_engine.schema import ANALYTICS_RESULT, REPORT
from trend_engine.sources.keyed import overwrite_partitions


def write_analytics(result: DataFrame, path: str) -> None:
    """The one-row analytics result as JSON (one row, so one small file)."""
    result.coalesce(1).write.mode("overwrite").json(path)


def read_analytics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ANALYTICS_RESULT).json(path)


def write_report(report: DataFrame, root: str) -> None:
    """Report rows under ``report_hour=YYYYMMDD_HH``; rewriting an hour replaces only that hour."""
    overwrite_partitions(report, root, "report_hour", "json")


def read_reports(spark: SparkSession, root: str, hours: list[str] | None = None) -> DataFrame:
    """The report files as a table; with ``hours`` only those files are listed and read."""
    rows = spark.read.schema(StructType([*REPORT.fields, StructField("report_hour", StringType())])).json(root)
    return rows if hours is None else rows.where(F.col("report_hour").isin(hours))
