"""Helpers shared by the operators: written tables, distributed numbering, connected groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trend_engine.session import scratch_dir

#: White space and words as the contracts define them (ASCII blanks only).
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"


def table(df: DataFrame, purpose: str, codec: str | None = None) -> DataFrame:
    """Write `df` as Parquet in the shared folder (compressed by `codec`, else as the session says) and read it back.

    Cuts the lineage: a lost executor costs a re-read of the files, never a recomputation.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words of a text (null: 0), without Python."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(df: DataFrame, order: list[Column], name: str, purpose: str) -> DataFrame:
    """`df` with a gapless position (from 0) in the given order, as a written table.

    A range sort deals the rows out; only one count per partition meets in one place.
    """
    at = table(df.sort(*order).withColumn("_at", F.monotonically_increasing_id()), purpose)
    part = F.shiftright("_at", 33)
    counts = at.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    out = at.withColumn("_part", part).join(F.broadcast(counts), "_part")
    return out.withColumn(name, F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_part", "_at", "_before")


def running_sum(df: DataFrame, group: str, order: list[str], value: str, name: str, purpose: str) -> DataFrame:
    """`df` with the sum of `value` over the earlier rows of its group, as a written table.

    A group of any size is spread over the range-sorted partitions: sums within a partition come
    from a window, the partitions' own totals (one row per partition and group) are added up.
    """
    at = table(df.sort(group, *order).withColumn("_at", F.monotonically_increasing_id()), purpose)
    at = at.withColumn("_part", F.shiftright("_at", 33))
    totals = at.groupBy(group, "_part").agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col(group).alias("_g"), F.col("_part").alias("_p"),
                           F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_earlier"))
    within = Window.partitionBy("_part", group).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    out = at.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
    out = out.join(totals, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
    return out.withColumn(name, F.col("_earlier") + F.col("_within")).drop("_g", "_p", "_part", "_at", "_earlier", "_within")


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """Connected groups of the graph `edges(a, b)`: one row (node, component) per node.

    `component` is the smallest node of the group. Alternates two steps until only stars remain:
    every edge is lowered to the smallest neighbour of its lower end, then a node's lower
    neighbours are hung under the smallest of them. Each round is a written table. Links stay in
    Spark throughout, and a node with many links is only ever a join key (AQE can split it).
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e = table(e, purpose)
    while not _stars(e):
        both = e.select(F.col("v").alias("n"), "u").unionByName(e.select(F.col("u").alias("n"), F.col("v").alias("u")))
        low = both.groupBy("n").agg(F.min("u").alias("m")).select("n", F.least("n", "m").alias("m"))
        e = e.join(low, e.v == low.n).select("u", F.col("m").alias("v")).where("u <> v").distinct()
        low = e.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
        hung = e.join(low, e.u == low.n).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = table(hung.unionByName(low.select(F.col("n").alias("u"), F.col("m").alias("v"))).distinct(), purpose)
    tops = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops)


def _stars(e: DataFrame) -> bool:
    """Whether every node has one lower neighbour at most and that one has none."""
    twice = e.groupBy("u").count().where("count > 1").select("u")
    inner = e.join(e.select(F.col("u").alias("w")), F.col("v") == F.col("w"), "left_semi").select("u")
    return twice.unionByName(inner).isEmpty()
