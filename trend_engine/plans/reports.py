"""One-row reports and payloads (trend report, analytics result, trending and stats payloads).

Each report is ONE global aggregate over a tagged union of three row sets:

* the serving rows (``p``): only count / exact-cents sums / max are computed from them, all
  partial-aggregated per task, so the serving table is never gathered anywhere;
* the top-k rows (``t``): already cut by TakeOrderedAndProject, at most k rows;
* the stats rows (``s``): the keyed counters table, a handful of rows.

``collect_list`` only ever sees the ``t`` and ``s`` rows, so what reaches the single final
aggregate task is bounded by k + number of stat keys, whatever the data size. No join (and no
cross join) is needed to put the pieces on one row. Where the serving rows are derived from observations, the
counting and the top-k branch share one latest-per-key shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampType

from trend_engine.functions.exact import mean_round2
from trend_engine.functions.timefmt import hour_label, iso_local, report_key
from trend_engine.operators.aggregates import stat_lookup
from trend_engine.operators.topk import top_k, with_rank
from trend_engine.schema import STAT_KEYS

STAT_STRUCT = StructType([StructField("stat_key", StringType()), StructField("stat_value", StringType()),
                          StructField("updated_at", TimestampType())])

# Payload field lists and sizes.
TREND_TOP = ("top_viral", 3, ["title", "score", "viral_score"])
ANALYTICS_TOP = ("top_posts", 5, ["id", "title", "viral_score"])
TRENDING_TOP = ("trending", 20, ["id", "title", "score", "comments", "viral_score", "author", "source"])
HEALTH_ACTIVE = "ACTIVE"


def _tagged(serving: DataFrame, stats: DataFrame | None, top_n: int, top_fields: Sequence[str]) -> DataFrame:
    if top_n > 0:
        top = with_rank(top_k(serving, top_n)).select(
            F.struct(F.col("rank"), *[F.col(c) for c in top_fields]).alias("_top"))
        top_type = top.schema["_top"].dataType
    else:
        top, top_type = None, StructType([StructField("rank", IntegerType())])
    null_top = F.lit(None).cast(top_type).alias("_top")
    null_stat = F.lit(None).cast(STAT_STRUCT).alias("_stat")
    no_score = F.lit(None).cast("double").alias("viral_score")
    parts = [serving.select(F.lit("p").alias("_kind"), F.col("viral_score"), null_top, null_stat)]
    if top is not None:
        parts.append(top.select(F.lit("t").alias("_kind"), no_score, "_top", null_stat))
    if stats is not None:
        parts.append(stats.select(
            F.lit("s").alias("_kind"), no_score, null_top,
            F.struct(F.col("stat_key"), F.col("stat_value"),
                     F.col("updated_at").cast("timestamp").alias("updated_at")).alias("_stat")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _top_array(top_fields: Sequence[str]) -> Column:
    fields = ", ".join(f"x.{c} AS {c}" for c in top_fields)
    # rank is the first struct field, so array_sort orders by rank
    return F.expr(f"transform(array_sort(collect_list(_top)), x -> struct({fields}))")


def _stats_map() -> Column:
    # Null for every other row, and collect_list drops nulls: only counter rows are gathered.
    return F.expr("map_from_entries(array_sort(collect_list(CASE WHEN _stat.stat_key IS NOT NULL THEN "
                  "struct(_stat.stat_key AS stat_key, _stat.stat_value AS stat_value) END)))")


def _now(now) -> Column:
    """Report time: the given instant, else the last pipeline update, else the wall clock."""
    if now is not None:
        return F.lit(now).cast("timestamp") if not isinstance(now, Column) else now
    return F.coalesce(F.max("_stat.updated_at"), F.current_timestamp())


def _figures() -> list[Column]:
    is_post, scored = F.col("_kind") == F.lit("p"), F.col("viral_score").isNotNull()
    # Counted in two parts so that this branch needs the packed latest row as the top-k branch does: the
    # two then share one shuffle of the posts (ReusedExchange) instead of each reducing them anew.
    total = F.count_if(is_post & scored) + F.count_if(is_post & ~scored)
    return [total.cast("bigint").alias("total_viral_posts"),
            F.coalesce(mean_round2("viral_score"), F.lit(0.0)).alias("avg_viral_score"),
            F.coalesce(F.round(F.max("viral_score"), 2), F.lit(0.0)).alias("peak_viral_score")]


def trend_report(serving: DataFrame, stats: DataFrame, now=None) -> DataFrame:
    """Hourly report: generated_at (NY ISO), hour, total, stats map, top 3 and the file key."""
    name, n, fields = TREND_TOP
    agg = _tagged(serving, stats, n, fields).agg(
        _now(now).alias("_at"), _figures()[0], _stats_map().alias("pipeline_stats"),
        _top_array(fields).alias(name))
    return agg.select(iso_local("_at").alias("generated_at"), hour_label("_at").alias("hour"),
                      "total_viral_posts", "pipeline_stats", name,
                      report_key("_at").alias("report_hour"))


def analytics_report(serving: DataFrame, stats: DataFrame, now=None) -> DataFrame:
    """Analytics result: generated_at, total, stats map, top 5 with full titles."""
    name, n, fields = ANALYTICS_TOP
    agg = _tagged(serving, stats, n, fields).agg(
        _now(now).alias("_at"), _figures()[0], _stats_map().alias("pipeline_stats"),
        _top_array(fields).alias(name))
    return agg.select(iso_local("_at").alias("generated_at"), "total_viral_posts", "pipeline_stats", name)


def trending_payload(serving: DataFrame, stats: DataFrame, source: str = "live", now=None) -> DataFrame:
    """``/trending``: generated_at, total, source, stats map, top 20 posts."""
    name, n, fields = TRENDING_TOP
    agg = _tagged(serving, stats, n, fields).agg(
        _now(now).alias("_at"), _figures()[0], _stats_map().alias("pipeline_stats"),
        _top_array(fields).alias(name))
    return agg.select(iso_local("_at").alias("generated_at"), "total_viral_posts",
                      F.lit(source).alias("source"), "pipeline_stats", name)


def stats_payload(serving: DataFrame, stats: DataFrame, source: str = "live") -> DataFrame:
    """``/stats``: count, counters (default "0"), 2-place average and peak (0 when empty)."""
    agg = _tagged(serving, stats, 0, []).agg(*_figures(), _stats_map().alias("_m"))
    return agg.select(
        "total_viral_posts",
        stat_lookup(F.col("_m"), "total_processed", "0").alias("total_processed"),
        stat_lookup(F.col("_m"), "viral_detected", "0").alias("viral_detected"),
        "avg_viral_score", "peak_viral_score",
        F.lit(HEALTH_ACTIVE).alias("pipeline_health"), F.lit(source).alias("source"))


def store_audit(serving: DataFrame, stats: DataFrame) -> DataFrame:
    """Stored-post count next to every counter (``N/A`` when missing)."""
    agg = _tagged(serving, stats, 0, []).agg(_figures()[0], _stats_map().alias("_m"))
    return agg.select(F.col("total_viral_posts").alias("stored_posts"),
                      *[stat_lookup(F.col("_m"), k, "N/A").alias(k) for k in STAT_KEYS])


def stats_listing(stats: DataFrame) -> DataFrame:
    """The analytics run's counter lines: each known key, ``N/A`` when missing."""
    from trend_engine.operators.aggregates import stats_map
    m = stats_map(stats)
    return m.select(*[stat_lookup(F.col("pipeline_stats"), k, "N/A").alias(k) for k in STAT_KEYS])


def as_json_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Render nested payload columns as JSON text (for files and engine-neutral comparison)."""
    return df.select(*[F.to_json(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])
