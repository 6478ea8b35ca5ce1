"""The serving store: the keyed table of viral posts, a ledger of batch counters, windowed topics.

Layout under a store root (any Hadoop-compatible path shared by the cluster)::

    viral_posts/bucket=<b>/        one row per post id: its latest viral observation
    rejects/run=<run>/epoch=<n>/   viral rows without an id (they cannot be keyed)
    ledger/block=<run>-<n>/        counters, added up per run and block of epochs: one row
    topics/day=<yyyy-MM-dd>/       windowed topic sums, added up per run

Each micro-batch merges its rows into the partitions they fall into (``sources.keyed``); a replayed
epoch changes nothing. ``run`` is the streaming query id kept in the checkpoint, so a lost checkpoint (epochs
restarting at 0) counts as a new run. The latest observation of a post is the one with the greatest
(ingested_at, offset, batch, Kafka partition, epoch).

The stored ``timestamp`` is the observation's own time; the time a row was put into the store is
``ingested_at``, which ``viral_latest(columns=[..., "ingested_at"])`` returns as well.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (IntegerType, LongType, StringType, StructField, StructType, TimestampType)

from trend_engine.operators.aggregates import stat_rows
from trend_engine.operators.latest import latest_per_key
from trend_engine.schema import VIRAL_FIELDS, VIRAL_POSTS
from trend_engine.sources import keyed

VIRAL, REJECTS, LEDGER, TOPICS = "viral_posts", "rejects", "ledger", "topics"

#: Buckets of the viral table where the job gives no number. Fixed for the life of a store (a rebuild into a
#: new root changes it); a bucket is what one merge rewrites, so choose about 128 MB a bucket.
BUCKETS = 16
#: Epochs whose counters share one ledger partition (a day of 15 s epochs).
BLOCK = 5760

LOG_META = [StructField("observed_at", TimestampType()), StructField("ingested_at", TimestampType()),
            StructField("partition", IntegerType()), StructField("offset", LongType())]
RUN_EPOCH = [StructField("run", StringType()), StructField("epoch", LongType())]
REJECTS_SCHEMA = StructType(list(VIRAL_POSTS.fields) + LOG_META + RUN_EPOCH)
VIRAL_SCHEMA = StructType(list(REJECTS_SCHEMA.fields) + [StructField("bucket", IntegerType())])
COUNTS = ["total_processed", "viral_detected", "rejected", "batches"]
LEDGER_SCHEMA = StructType(
    [StructField("run", StringType())] + [StructField(c, LongType()) for c in COUNTS]
    + [StructField("last", StructType([StructField("updated_at", TimestampType()), StructField("epoch", LongType()),
                                       StructField("total_processed", LongType()), StructField("viral_detected", LongType())])),
       StructField("upto", LongType()), StructField("block", StringType())])
# A key stays in one Kafka partition, so its offsets are its arrival order; the poll counter starts
# anew with the producer and only decides where there are no offsets (file source).
VIRAL_ORDER = ["ingested_at", "offset", "batch_num", "partition", "epoch"]


def _path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def bucket_of(post_id, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(post_id), F.lit(buckets)).cast("int")


def viral_rows(batch: DataFrame, run: str, epoch: int, buckets: int = BUCKETS) -> DataFrame:
    """The viral rows of a parsed micro-batch in the table's shape (null bucket: no id)."""
    meta = [F.col(c).cast(t).alias(c) if c in batch.columns else F.lit(None).cast(t).alias(c)
            for c, t in (("partition", "int"), ("offset", "bigint"))]
    return batch.filter(F.col("is_viral")).select(
        "id", "title", "score", "comments", "viral_score", "source", "author",
        F.col("observed_at").alias("timestamp"), F.col("batch").alias("batch_num"),
        "observed_at", "ingested_at", *meta, F.lit(run).alias("run"), F.lit(epoch).cast("long").alias("epoch"),
        F.when(F.col("id").isNotNull(), bucket_of("id", buckets)).alias("bucket"))


def upsert_viral(spark: SparkSession, rows: DataFrame, root: str) -> None:
    """Merge viral rows (``viral_rows``) into the keyed table."""
    keyed.merge_latest(spark, _path(root, VIRAL), VIRAL_SCHEMA, rows.where("bucket IS NOT NULL"), "bucket", ["id"], VIRAL_ORDER)


def write_rejects(rows: DataFrame, root: str) -> None:
    """Keep the rows without an id, one directory per epoch (a replay replaces it)."""
    keyed.overwrite_partitions(rows.where("bucket IS NULL").drop("bucket"), _path(root, REJECTS), ["run", "epoch"])


def add_counts(spark: SparkSession, root: str, run: str, epoch: int, total: int, viral: int, rejected: int, at) -> None:
    """Add one micro-batch's counters to the ledger (once, however often the epoch is replayed).

    The block's single row is read, added to and written; epochs of a run come in their order."""
    block = f"{run}-{epoch // BLOCK}"
    old = ledger(spark, root).where(F.col("block") == block).first()
    if old is not None and old.upto >= epoch:
        return
    counts = [n + (old[c] if old else 0) for c, n in zip(COUNTS, (total, viral, rejected, 1), strict=True)]
    row = spark.createDataFrame([(run, *counts, (at, epoch, total, viral), epoch, block)], LEDGER_SCHEMA)
    keyed.overwrite_partitions(row.coalesce(1), _path(root, LEDGER), "block")


def store_exists(spark: SparkSession, root: str) -> bool:
    """True when the store has a viral table (it lists the directory but reads no file)."""
    try:
        spark.read.schema(VIRAL_SCHEMA).parquet(_path(root, VIRAL))
        return True
    except AnalysisException:
        return False


def viral_table(spark: SparkSession, root: str) -> DataFrame:
    """The keyed table with all its columns."""
    return keyed.read_table(spark, _path(root, VIRAL), VIRAL_SCHEMA)


def viral_latest(spark: SparkSession, root: str, columns: list[str] | None = None) -> DataFrame:
    """The latest viral observation of every id: a plain scan of the asked columns."""
    values = [c for c in VIRAL_FIELDS[1:] if columns is None or c in columns]
    extra = [c for c in ("ingested_at",) if columns and c in columns]
    return viral_table(spark, root).select("id", *values, *extra)


def viral_posts_by_id(spark: SparkSession, root: str, ids: list[str], buckets: int = BUCKETS) -> DataFrame:
    """The stored rows of some ids; only their buckets are listed and read."""
    table = viral_table(spark, root)
    wanted = F.lit(False)
    for i in ids:
        wanted = wanted | ((F.col("bucket") == bucket_of(F.lit(i), buckets)) & (F.col("id") == F.lit(i)))
    return table.where(wanted).select(*VIRAL_FIELDS)


def rebuild_viral(spark: SparkSession, root: str, raw: DataFrame, buckets: int = BUCKETS) -> None:
    """Write the keyed table anew from raw-table observations (``catalog.observations``), for instance
    after a lost partition: the latest viral observation per id by
    (observed_at, batch). Partitions without rows in ``raw`` stay as they are."""
    rows = viral_rows(raw.withColumn("ingested_at", F.col("observed_at")), "rebuilt", 0, buckets)
    order = ["observed_at", "batch_num"]
    rest = [c for c in VIRAL_SCHEMA.fieldNames() if c not in ("id", "bucket")]
    latest = latest_per_key(rows.where("bucket IS NOT NULL"), ["bucket", "id"], order, rest)
    keyed.overwrite_partitions(latest.repartition(F.col("bucket")), _path(root, VIRAL), "bucket")


def ledger(spark: SparkSession, root: str) -> DataFrame:
    return keyed.read_table(spark, _path(root, LEDGER), LEDGER_SCHEMA)


def stats_latest(spark: SparkSession, root: str) -> DataFrame:
    """The keyed counters table: the counters of the last micro-batch as key/value rows."""
    last = ledger(spark, root).agg(F.max("last").alias("last")).where("last IS NOT NULL").select("last.*")
    return stat_rows(last)


def cumulative_counts(spark: SparkSession, root: str) -> DataFrame:
    """Totals over every micro-batch (the 'total processed' figure as a true total)."""
    return ledger(spark, root).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS])


def rejects(spark: SparkSession, root: str) -> DataFrame:
    """Viral rows that could not be keyed (null id)."""
    return keyed.read_table(spark, _path(root, REJECTS), REJECTS_SCHEMA)


def load_serving(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Both stored tables, as every reader (analytics, report, API) uses them."""
    return viral_latest(spark, root), stats_latest(spark, root)
