"""Aggregations: tiers, leaderboards, counters, summaries, rollups.

All are ``groupBy(...).agg(...)`` on built-in aggregates, so Spark plans a partial
aggregate before the shuffle and a final one after it; a hot group key only ever ships one
partial row per task. Averages over two-decimal scores use exact cents (``functions.exact``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trend_engine.functions.exact import cents, mean_exact, mean_exact_sql, mean_int, mean_int_sql, mean_round2, round2_sql
from trend_engine.functions.scoring import preview, tier
from trend_engine.functions.timefmt import hour_label
from trend_engine.schema import STAT_KEYS


def tier_distribution(df: DataFrame, score_col: str = "viral_score") -> DataFrame:
    """Count and 2-place average score per tier, highest average first."""
    return (df.groupBy(tier(score_col).alias("category"))
              .agg(F.count(F.lit(1)).alias("post_count"), mean_round2(score_col).alias("avg_score"))
              .orderBy(F.desc("avg_score"), F.asc("category")))


def author_leaderboard(df: DataFrame, n: int = 5) -> DataFrame:
    """Posts, 2-place average viral score and best raw score per author; top ``n`` by average."""
    return (df.groupBy("author")
              .agg(F.count(F.lit(1)).alias("viral_posts"),
                   mean_round2("viral_score").alias("avg_viral_score"),
                   F.max("score").alias("best_score"))
              .orderBy(F.desc("avg_viral_score"), F.asc_nulls_last("author"))
              .limit(n))


def viral_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_viral"))


#: Figures of the topic leaderboard, as aggregate expressions (the operator and the SQL view share them).
TOPIC_FIGURES = {
    "post_count": "count(1)",
    "avg_score": mean_int_sql("score"),
    "avg_viral_score": mean_exact_sql("viral_score"),
    "total_comments": "sum(CAST(comments AS BIGINT))",
    "peak_viral_score": "max(viral_score)",
}


def topic_leaderboard(df: DataFrame, topic_col: str = "subreddit") -> DataFrame:
    """Over viral observations (not distinct posts): count, averages, comment sum and peak per topic."""
    return (viral_only(df).groupBy(topic_col)
              .agg(*[F.expr(e).alias(name) for name, e in TOPIC_FIGURES.items()])
              .orderBy(F.desc("avg_viral_score"), F.asc(topic_col)))


def topic_leaderboard_sql(table: str, topic_col: str = "subreddit") -> str:
    """The same as a query text over a table, for a view."""
    figures = ", ".join(f"{e} AS {name}" for name, e in TOPIC_FIGURES.items())
    return f"SELECT {topic_col}, {figures} FROM {table} WHERE is_viral GROUP BY {topic_col} ORDER BY avg_viral_score DESC, {topic_col}"


def batch_counts(df: DataFrame, by: Sequence[str] | None = None,
                 time_col: str | None = "observed_at") -> DataFrame:
    """Rows processed and viral rows (null flags count as not viral), globally or per ``by``."""
    aggs = [F.count(F.lit(1)).alias("total_processed"),
            F.count_if(F.col("is_viral")).cast("bigint").alias("viral_detected")]
    if time_col:
        aggs.append(F.max(time_col).alias("updated_at"))
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def last_poll_counts(per_poll: DataFrame, order: str = "batch") -> DataFrame:
    """The counters of the greatest ``order`` value, as one row (global max_by, no sort)."""
    fields = list(per_poll.columns)
    last = per_poll.agg(F.max_by(F.struct(*fields), F.col(order)).alias("_last"))
    return last.select(*[F.col(f"_last.{c}").alias(c) for c in fields])


def stat_rows(counts: DataFrame, epoch_col: str = "epoch", time_col: str = "updated_at") -> DataFrame:
    """One counters row → key/value rows ``(stat_key, stat_value, updated_at)``."""
    values = {"total_processed": F.col("total_processed"), "viral_detected": F.col("viral_detected"),
              "last_batch_time": F.col(epoch_col)}
    entries = F.array(*[F.struct(F.lit(k).alias("stat_key"), values[k].cast("string").alias("stat_value"))
                        for k in STAT_KEYS])
    return (counts.select(F.explode(entries).alias("e"), F.col(time_col).alias("updated_at"))
                  .select("e.stat_key", "e.stat_value", "updated_at"))


def stats_map(stats: DataFrame) -> DataFrame:
    """Fold the stats table into one ``map<string,string>`` row.

    The rows are first reduced to one per ``stat_key`` (latest ``updated_at``), so what is
    collected is bounded by the number of distinct keys even if a raw log is passed in.
    """
    keyed = stats.groupBy("stat_key").agg(F.max_by("stat_value", "updated_at").alias("stat_value"))
    entries = F.array_sort(F.collect_list(F.struct("stat_key", "stat_value")))
    return keyed.agg(F.map_from_entries(entries).alias("pipeline_stats"))


def stat_lookup(map_col: Column, key: str, default: str) -> Column:
    """``map[key]``, or ``default`` when the key is missing."""
    return F.coalesce(map_col.getItem(key), F.lit(default))


def poll_summary(df: DataFrame) -> DataFrame:
    """Per poll: posts sent, viral posts, and the first-listed post's 60-char title and score."""
    first = F.min_by(F.struct("title", "score"), F.col("list_rank"))
    return (df.groupBy("batch")
              .agg(F.count(F.lit(1)).alias("sent"),
                   F.count_if(F.col("is_viral")).cast("bigint").alias("viral"),
                   first.alias("_first"))
              .select("batch", "sent", "viral", preview("_first.title", 60).alias("top_title"),
                      F.col("_first.score").alias("top_score")))


def hourly_rollup(df: DataFrame, time_col: str = "observed_at") -> DataFrame:
    """Per UTC hour: posts, viral posts, 2-place average viral score, top title.

    The top title is the one with the highest viral score; ties go to the later batch, then to
    the greater id.
    """
    top = F.max_by(F.col("title"), F.struct("viral_score", "batch", "id"))
    return (df.groupBy(hour_label(time_col, zone=None).alias("hour_bucket"))
              .agg(F.count(F.lit(1)).alias("total_posts"),
                   F.count_if(F.col("is_viral")).cast("bigint").alias("viral_posts"),
                   mean_round2("viral_score").alias("avg_viral_score"),
                   top.alias("top_title")))


#: How two hour partials become one.
HOUR_SUMS = {"total_posts": F.sum, "viral_posts": F.sum, "scored": F.sum, "cents": F.sum, "best": F.max}


def hour_parts(df: DataFrame, by: Sequence[str] = (), time_col: str = "observed_at") -> DataFrame:
    """What ``df`` adds to each UTC hour (per ``by``): counts, cents and the best observation, which is the
    greatest (viral score, batch, id). Partials of any split of the rows add up to the same hours."""
    return (df.groupBy(hour_label(time_col, zone=None).alias("hour_bucket"), *by)
              .agg(F.count(F.lit(1)).alias("total_posts"),
                   F.count_if(F.col("is_viral")).cast("bigint").alias("viral_posts"),
                   F.count("viral_score").alias("scored"),
                   F.sum(cents("viral_score")).alias("cents"),
                   F.max(F.struct("viral_score", "batch", "id", "title")).alias("best")))


def hours_of_parts(parts: DataFrame) -> DataFrame:
    """``hourly_rollup`` from any number of ``hour_parts``."""
    both = parts.groupBy("hour_bucket").agg(*[f(c).alias(c) for c, f in HOUR_SUMS.items()])
    return both.select("hour_bucket", "total_posts", "viral_posts",
                       F.expr(round2_sql("cents", "scored")).alias("avg_viral_score"),
                       F.col("best.title").alias("top_title"))


def windowed_topics(df: DataFrame, size: str = "1 hour", time_col: str = "observed_at",
                    topic_col: str = "subreddit") -> DataFrame:
    """Topic × tumbling window: post count, averages and comment sum."""
    return (df.groupBy(F.window(time_col, size).alias("w"), F.col(topic_col).alias("topic"))
              .agg(F.count(F.lit(1)).alias("post_count"),
                   mean_int("score").alias("avg_score"),
                   mean_exact("viral_score").alias("avg_viral_score"),
                   F.sum(F.col("comments").cast("bigint")).alias("total_comments"))
              .select("topic", F.col("w.start").alias("window_start"), "post_count", "avg_score",
                      "avg_viral_score", "total_comments"))


def topic_parts(df: DataFrame, size: str = "1 hour", time_col: str = "observed_at",
                topic_col: str = "subreddit") -> DataFrame:
    """What ``df`` adds to each topic × tumbling window: whole sums and counts of non-null values."""
    return (df.groupBy(F.window(time_col, size).alias("w"), F.col(topic_col).alias("topic"))
              .agg(F.count(F.lit(1)).alias("post_count"),
                   F.count("score").alias("scores"),
                   F.sum(F.col("score").cast("bigint")).alias("score_sum"),
                   F.count("viral_score").alias("virals"),
                   F.sum(cents("viral_score")).alias("cents"),
                   F.sum(F.col("comments").cast("bigint")).alias("total_comments"))
              .select("topic", F.col("w.start").alias("window_start"), "post_count", "scores", "score_sum",
                      "virals", "cents", "total_comments"))


def topics_of_parts(parts: DataFrame) -> DataFrame:
    """``windowed_topics`` from any number of ``topic_parts``."""
    mean = lambda total, n: F.sum(total).cast("double") / F.expr(f"nullif(sum({n}), 0)").cast("double")
    return (parts.groupBy("topic", "window_start")
                 .agg(F.sum("post_count").alias("post_count"),
                      mean("score_sum", "scores").alias("avg_score"),
                      (F.sum("cents").cast("double")
                       / F.expr("nullif(sum(virals), 0) * 100").cast("double")).alias("avg_viral_score"),
                      F.sum("total_comments").alias("total_comments")))
