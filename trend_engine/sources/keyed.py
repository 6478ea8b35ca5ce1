"""Keyed Parquet tables that are merged partition by partition.

A table is a directory of Parquet files under one partition column. A merge reads only the partitions
the new rows fall into, combines old and new rows with an ordinary aggregate and writes those partitions
back with Spark's dynamic partition overwrite; all others are left as they are. So a table always
holds one row per key, a read is a plain scan (pruned by partition), and nothing has to be compacted.

Two ways of combining:

* ``merge_latest``: the row with the greatest order wins. Merging the same rows again changes nothing.
* ``merge_sums``: additive figures. Every row keeps the last epoch of its run that went into it (``upto``);
  rows of an epoch that a partition already has are left out, so a replayed epoch adds nothing, also when
  a failure came between the partitions of one write.

Lost executors recompute their tasks from the old files, which stay until the job commits. The commit
replaces a partition's directory; a driver that dies inside that step can lose that partition, which
``store.rebuild_viral`` and a fresh roll-up of the raw table restore.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trend_engine.operators.latest import latest_per_key


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Parquet under ``path`` (partition columns discovered below it) with a declared schema,
    or an empty frame of that schema when nothing has been written yet."""
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


def overwrite_partitions(rows: DataFrame, path: str, partition: str | list[str], fmt: str = "parquet") -> None:
    """Write ``rows``, replacing exactly the partitions they fall into."""
    names = [partition] if isinstance(partition, str) else partition
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*names).format(fmt).save(path)


def _touched(spark: SparkSession, path: str, schema: StructType, rows: DataFrame, partition: str):
    """The table's partitions that ``rows`` fall into (their values reach the driver: as many as the
    table has partitions at most), or None without rows."""
    values = [r[0] for r in rows.select(partition).distinct().collect()]
    if not values:
        return None
    return read_table(spark, path, schema).where(F.col(partition).isin(values))


def merge_latest(spark: SparkSession, path: str, schema: StructType, rows: DataFrame, partition: str,
                 keys: Sequence[str], order: Sequence[str]) -> None:
    """Put ``rows`` into the table: per key the row with the greatest ``order`` stays.

    The partition column must be a function of the key. New rows are reduced to one per key before they
    move, so a hot key moves one row per task; then each partition is merged by the task that writes it.
    """
    old = _touched(spark, path, schema, rows, partition)
    if old is None:
        return
    keys = [partition, *keys]
    rest = [c for c in schema.fieldNames() if c not in keys]
    new = latest_per_key(rows, keys, order, rest).select(*schema.fieldNames())
    both = old.unionByName(new).repartition(F.col(partition))
    overwrite_partitions(latest_per_key(both, keys, order, rest), path, partition)


def merge_sums(spark: SparkSession, path: str, schema: StructType, rows: DataFrame, partition: str,
               keys: Sequence[str], sums: dict[str, Column]) -> None:
    """Add ``rows`` (partition, run, epoch, keys and figures) to the table's figures.

    ``sums`` gives for each figure the aggregate that combines two of it. Rows of a run come in
    the order of its epochs. The table has the columns partition, run, keys, figures and ``upto``.
    """
    old = _touched(spark, path, schema, rows, partition)
    if old is None:
        return
    seen = old.groupBy(F.col(partition).alias("_part"), F.col("run").alias("_run")).agg(F.max("upto").alias("_seen"))
    fresh = rows.join(seen, (F.col(partition) == F.col("_part")) & (F.col("run") == F.col("_run")), "left")
    fresh = fresh.where(F.col("epoch") > F.coalesce(F.col("_seen"), F.lit(-1))).withColumn("upto", F.col("epoch").cast("long"))
    by = [partition, "run", *keys]
    figures = [*[agg.alias(name) for name, agg in sums.items()], F.max("upto").alias("upto")]
    new = fresh.groupBy(*by).agg(*figures)
    both = old.unionByName(new.select(*schema.fieldNames())).repartition(F.col(partition))
    overwrite_partitions(both.groupBy(*by).agg(*figures).sortWithinPartitions(*by), path, partition)
