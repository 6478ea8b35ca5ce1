"""Edge micro-fixtures: boundaries, defaults, bad input, ordering, time zones, overflow."""

import datetime as dt

import pytest
from pyspark.sql.types import DoubleType, StructField, StructType, TimestampType

from trend_engine.functions.scoring import is_viral, tier, tier_label, viral_score
from trend_engine.functions.timefmt import hour_label, iso_local, report_key
from trend_engine.operators.aggregates import batch_counts
from trend_engine.operators.topk import top_k
from trend_engine.plans import reports
from trend_engine.sources.items import head_of_list, normalise_items
from trend_engine.sources.messages import parse_posts

SCORE = StructType([StructField("viral_score", DoubleType())])


def _score(spark, rows):
    df = spark.createDataFrame(rows, "score int, comments int, unix_time long, now double")
    return [r[0] for r in df.select(viral_score("score", "comments", "unix_time", "now")).collect()]


def test_boundary_50_is_viral_tier_but_not_flag(spark):
    r = spark.createDataFrame([(50.0,)], SCORE).select(
        tier("viral_score").alias("t"), tier_label("viral_score").alias("l"),
        is_viral("viral_score").alias("v")).first()
    assert r.t == "VIRAL (50-75)" and r.l == "📈 VIRAL" and r.v is False


def test_rounding_to_boundary(spark):
    # 260 / (h + 2)^1.5 with age 3604.8 s is 50.00x before rounding
    now = 1_700_000_000.0
    raw = 260 / ((3604.8 / 3600) + 2) ** 1.5
    assert 50.0 < raw < 50.005
    df = spark.createDataFrame([(260, 0, int(now - 3604), now + 0.8)],
                               "score int, comments int, unix_time long, now double")
    r = df.select(viral_score("score", "comments", "unix_time", "now").alias("s")) \
          .select("s", is_viral("s").alias("v")).first()
    assert r.s == 50.0 and r.v is False


def test_age_floor_and_clock_skew(spark):
    now = 1_700_000_000.0
    a = _score(spark, [(100, 10, int(now) - 600, now), (100, 10, int(now) + 900, now),
                       (100, 10, int(now) - 3600, now)])
    assert a[0] == a[1] == a[2] == round(120 / 27 ** 0.5, 2)


def test_score_falls_with_age(spark):
    now = 1_700_000_000.0
    s = _score(spark, [(500, 50, int(now) - h * 3600, now) for h in (1, 2, 5, 12, 48)])
    assert s == sorted(s, reverse=True) and len(set(s)) == 5


def test_overflow_safe(spark):
    big = 2**31 - 1
    s = _score(spark, [(big, big, 0, 3600.0)])
    assert s[0] == pytest.approx((big + 2 * big) / 3 ** 1.5, abs=0.005)


ITEMS = "id long, type string, title string, score int, descendants int, by string, url string, time long, " \
        "list_rank int, observed_at timestamp"


def test_defaults_and_filters(spark):
    at = dt.datetime(2024, 1, 1, 12, 0, tzinfo=dt.timezone.utc)
    rows = [
        (1, "story", "kept", None, None, None, None, None, 0, at),
        (2, "job", "a job", 5, 1, "x", "u", 100, 1, at),
        (3, "story", "", 5, 1, "x", "u", 100, 2, at),
        (4, "story", None, 5, 1, "x", "u", 100, 3, at),
        (5, "story", "full", 7, 2, "amy", "http://x", 99, 4, at),
    ]
    out = {r.id: r for r in normalise_items(spark.createDataFrame(rows, ITEMS)).collect()}
    assert set(out) == {"1", "5"}
    assert (out["1"].score, out["1"].comments, out["1"].author, out["1"].url) == (0, 0, "unknown", "")
    assert out["1"].unix_time == int(at.timestamp())
    assert out["5"].source == "hackernews" and out["5"].subreddit in (
        "technology", "programming", "MachineLearning", "datascience", "artificial", "Python")
    # the variant without the type check keeps the job
    assert {r.id for r in normalise_items(spark.createDataFrame(rows, ITEMS), story_only=False).collect()} \
        == {"1", "2", "5"}


def test_head_cut_before_filter(spark):
    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [(i, "job" if i == 3 else "story", f"t{i}", 1, 1, "a", "", 1, i, at) for i in range(40)]
    df = spark.createDataFrame(rows, ITEMS)
    out = normalise_items(head_of_list(df, 30)).collect()
    assert len(out) == 29


def test_bad_json_counts_but_not_viral(spark):
    good = '{"id":"1","title":"t","score":1,"comments":1,"author":"a","source":"s","subreddit":"x",' \
           '"viral_score":60.0,"is_viral":true,"timestamp":"2024-01-01T00:00:00.000000","unix_time":1,"batch":1}'
    raw = spark.createDataFrame([(good,), ("not json",)], "value string")
    parsed = parse_posts(raw)
    rows = parsed.collect()
    assert len(rows) == 2 and sum(r.id is None for r in rows) == 1
    c = batch_counts(parsed, time_col=None).first()
    assert (c.total_processed, c.viral_detected) == (2, 1)


def test_ties_ordered_by_id(spark):
    df = spark.createDataFrame([("b", 70.0), ("a", 70.0), ("c", 80.0), ("d", 10.0)], "id string, viral_score double")
    assert [r.id for r in top_k(df, 3).collect()] == ["c", "a", "b"]


def test_dst_renderings(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 7, 13, 16, 23, 42, 733006, tzinfo=dt.timezone.utc),),
                                (dt.datetime(2026, 1, 13, 16, 23, 42, 733006, tzinfo=dt.timezone.utc),)],
                               StructType([StructField("ts", TimestampType())]))
    r = df.select(iso_local("ts").alias("iso"), hour_label("ts").alias("h"), report_key("ts").alias("k")).collect()
    assert r[0].iso == "2026-07-13T12:23:42.733006-04:00" and r[0].h == "2026-07-13 12:00" and r[0].k == "20260713_12"
    assert r[1].iso == "2026-01-13T11:23:42.733006-05:00" and r[1].h == "2026-01-13 11:00"


SERVING = "id string, title string, score int, comments int, viral_score double, source string, author string, " \
          "timestamp timestamp, batch_num int"
STATS = "stat_key string, stat_value string, updated_at timestamp"


def test_empty_serving_summary(spark):
    empty = spark.createDataFrame([], SERVING)
    r = reports.stats_payload(empty, spark.createDataFrame([], STATS)).first()
    assert (r.total_viral_posts, r.avg_viral_score, r.peak_viral_score) == (0, 0.0, 0.0)
    assert (r.total_processed, r.viral_detected) == ("0", "0")
    t = reports.trend_report(empty, spark.createDataFrame([], STATS)).first()
    assert t.total_viral_posts == 0 and t.top_viral == []


def test_missing_stat_key(spark):
    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    stats = spark.createDataFrame([("total_processed", "30", at)], STATS)
    listing = reports.stats_listing(stats).first()
    assert (listing.total_processed, listing.viral_detected, listing.last_batch_time) == ("30", "N/A", "N/A")
    summ = reports.stats_payload(spark.createDataFrame([], SERVING), stats).first()
    assert summ.viral_detected == "0" and summ.total_processed == "30"
