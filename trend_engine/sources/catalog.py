"""Tables and views for SQL use: the delimited raw-posts table, the ORC hourly table, views.

The raw table is CSV (quotes commas inside titles, which a plain delimiter cannot); the hourly table is
ORC partitioned by day. ``register`` makes session temp views, ``create_catalog`` a database with
external tables and views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from trend_engine.functions.scoring import sql_literal
from trend_engine.operators.aggregates import topic_leaderboard, topic_leaderboard_sql
from trend_engine.operators.views import viral_posts_sql, viral_posts_view
from trend_engine.schema import HOURLY_STATS, RAW_POSTS
from trend_engine.sources.keyed import overwrite_partitions

HOURLY_TABLE = StructType([*HOURLY_STATS.fields, StructField("day", StringType())])

# Blanks are kept, null and empty text differ, and a line that doesn't fit stops the read.
CSV_OPTS = {"header": "false", "quote": '"', "escape": '"', "nullValue": r"\N", "emptyValue": "",
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
CSV_READ = {**CSV_OPTS, "mode": "FAILFAST"}
RAW_POST_COLS = [f.name for f in RAW_POSTS.fields]
RAW_TEXT_COLS = [f.name for f in RAW_POSTS.fields if f.dataType.typeName() == "string"]
# A file of lines can be split by readers only if no value holds a line end: these are written in
# percent form ("%" first on the way out, last on the way in).
CSV_ESCAPES = [("%", "%25"), ("\n", "%0A"), ("\r", "%0D"), ("\\", "%5C")]


# An empty text, which a delimited file cannot tell from no text in every writer: a "%" on its own.
CSV_EMPTY = "%"


def _escaped(df: DataFrame) -> DataFrame:
    for c in RAW_TEXT_COLS:
        text = F.col(c)
        for plain, code in CSV_ESCAPES:
            text = F.replace(text, F.lit(plain), F.lit(code))
        df = df.withColumn(c, F.when(F.col(c) == "", F.lit(CSV_EMPTY)).otherwise(text))
    return df


def _plain_sql(column: str) -> str:
    text = column
    for plain, code in reversed(CSV_ESCAPES):
        text = f"replace({text}, {sql_literal(code)}, {sql_literal(plain)})"
    return f"CASE WHEN {column} = {sql_literal(CSV_EMPTY)} THEN '' ELSE {text} END"


def _plain(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.expr(_plain_sql(c)) for c in RAW_TEXT_COLS})


def _raw_cols(posts: DataFrame):
    return [F.col("batch").alias("batch_num") if c == "batch_num" else F.col(c) for c in RAW_POST_COLS]


def _write_raw(posts: DataFrame, path: str, fmt: str, mode: str) -> None:
    rows = posts.select(*_raw_cols(posts))
    if fmt == "csv":
        _escaped(rows).write.mode(mode).options(**CSV_OPTS).csv(path)
    else:
        rows.write.mode(mode).format(fmt).save(path)


def append_raw_posts(posts: DataFrame, path: str, fmt: str = "csv") -> None:
    """Append observations to the raw table (``batch`` stored as ``batch_num``).

    ``csv`` is the declared delimited format; ``parquet`` gives column pruning and pushdown,
    which a raw table at scale needs.
    """
    _write_raw(posts, path, fmt, "append")


def write_raw_epoch(posts: DataFrame, path: str, run: str, epoch: int, fmt: str = "csv") -> None:
    """One micro-batch's observations into ``run=<run>/epoch=<n>`` (overwrite: replay-safe)."""
    _write_raw(posts, f"{path.rstrip('/')}/run={run}/epoch={epoch}", fmt, "overwrite")


def raw_posts(spark: SparkSession, path: str, fmt: str = "csv", epochs: bool = False) -> DataFrame:
    """The raw table (flat, or laid out per run/epoch by the stream); ``epochs`` adds run and epoch."""
    more = [StructField("run", StringType()), StructField("epoch", LongType())] if epochs else []
    schema = StructType(list(RAW_POSTS.fields) + more)
    r = spark.read.schema(schema).option("basePath", path).option("recursiveFileLookup", "false")
    df = _plain(r.options(**CSV_READ).csv(path)) if fmt == "csv" else r.format(fmt).load(path)
    return df.select(*schema.fieldNames())


def observations(raw: DataFrame) -> DataFrame:
    """Raw-table rows in the observation shape the rollups take (``batch``, ``observed_at``)."""
    from trend_engine.functions.timefmt import parse_iso_utc
    return raw.withColumnRenamed("batch_num", "batch").withColumn("observed_at", parse_iso_utc("timestamp"))


def write_hourly(rollup: DataFrame, path: str) -> None:
    """Write hourly rows to ORC, replacing only the days present in ``rollup``."""
    overwrite_partitions(rollup.withColumn("day", F.substring("hour_bucket", 1, 10)), path, "day", "orc")


def hourly(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HOURLY_TABLE).orc(path).select(*HOURLY_STATS.fieldNames())


def register(spark: SparkSession, tables: dict[str, DataFrame], views: bool = True) -> None:
    """Register DataFrames as temp views; with ``views``, also the two views over ``raw_posts``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    if views and "raw_posts" in tables:
        topic_leaderboard(tables["raw_posts"]).createOrReplaceTempView("topic_leaderboard")
        viral_posts_view(tables["raw_posts"]).createOrReplaceTempView("viral_posts_view")


# ---- catalog objects ----------------------------------------------------------------------------

def _columns_sql(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)


def create_catalog(spark: SparkSession, database: str, root: str) -> None:
    """The database and its objects, where they do not exist yet (files under ``root``):

    * ``raw_lines``: external delimited table, text in its escaped form; ``raw_posts``: view of it in plain text;
    * ``hourly_stats``: external ORC table, partitioned by day;
    * ``topic_leaderboard`` and ``viral_posts_view``: views over ``raw_posts``, from the operators' own expressions.

    They live in the session's catalog: with a metastore they outlast the session.
    """
    root = root.rstrip("/")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} COMMENT 'post observations' LOCATION {sql_literal(root)}")
    options = ", ".join(f"{sql_literal(k)} = {sql_literal(v)}" for k, v in CSV_READ.items())
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.raw_lines ({_columns_sql(RAW_POSTS)}) USING csv "
              f"OPTIONS ({options}) LOCATION {sql_literal(root + '/raw_lines')}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.hourly_stats ({_columns_sql(HOURLY_TABLE)}) USING orc "
              f"OPTIONS ('partitionOverwriteMode' = 'dynamic') PARTITIONED BY (day) LOCATION {sql_literal(root + '/hourly_stats')}")
    plain = ", ".join(f"{_plain_sql(f'`{f.name}`')} AS `{f.name}`" if f.name in RAW_TEXT_COLS else f"`{f.name}`" for f in RAW_POSTS.fields)
    for view, body in {"raw_posts": f"SELECT {plain} FROM {database}.raw_lines",
                       "topic_leaderboard": topic_leaderboard_sql(f"{database}.raw_posts"),
                       "viral_posts_view": viral_posts_sql(f"{database}.raw_posts")}.items():
        spark.sql(f"CREATE VIEW IF NOT EXISTS {database}.{view} AS {body}")


def insert_raw(spark: SparkSession, database: str, posts: DataFrame) -> None:
    """Append observations to the database's delimited table."""
    _escaped(posts.select(*_raw_cols(posts))).write.insertInto(f"{database}.raw_lines")


def insert_hourly(spark: SparkSession, database: str, rollup: DataFrame) -> None:
    """Put hourly rows into the database's ORC table, replacing only the days they fall into (the table's
    own option says so)."""
    rows = rollup.withColumn("day", F.substring("hour_bucket", 1, 10)).select(*HOURLY_TABLE.fieldNames())
    rows.write.insertInto(f"{database}.hourly_stats", overwrite=True)
