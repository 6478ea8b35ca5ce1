"""Golden: the saved serving state (two stored posts, last batch 30 processed / 2 viral)."""

import datetime as dt

from trend_engine.operators.board import board
from trend_engine.plans import reports

SERVING = "id string, title string, score int, comments int, viral_score double, source string, author string, " \
          "timestamp timestamp, batch_num int"
STATS = "stat_key string, stat_value string, updated_at timestamp"
AT = dt.datetime(2026, 7, 13, 16, 23, 42, 733006, tzinfo=dt.timezone.utc)


def _state(spark):
    serving = spark.createDataFrame([
        ("48889637", "first title", 1120, 567, 74.4, "hackernews", "crowdhailer", AT, 88),
        ("48892512", "second title", 378, 191, 74.28, "hackernews", "tnolet", AT, 88),
    ], SERVING)
    stats = spark.createDataFrame([("viral_detected", "2", AT), ("last_batch_time", "88", AT),
                                   ("total_processed", "30", AT)], STATS)
    return serving, stats


def test_stats_payload_matches_saved(spark):
    r = reports.stats_payload(*_state(spark)).first().asDict()
    assert r == {"total_viral_posts": 2, "total_processed": "30", "viral_detected": "2",
                 "avg_viral_score": 74.34, "peak_viral_score": 74.4, "pipeline_health": "ACTIVE",
                 "source": "live"}


def test_trending_payload_matches_saved(spark):
    r = reports.trending_payload(*_state(spark)).first()
    assert r.generated_at == "2026-07-13T12:23:42.733006-04:00"
    assert r.total_viral_posts == 2
    assert dict(r.pipeline_stats) == {"viral_detected": "2", "last_batch_time": "88", "total_processed": "30"}
    assert [(p.id, p.score, p.comments, p.viral_score, p.author) for p in r.trending] == [
        ("48889637", 1120, 567, 74.4, "crowdhailer"), ("48892512", 378, 191, 74.28, "tnolet")]


def test_trend_report_hour_and_board(spark):
    serving, stats = _state(spark)
    t = reports.trend_report(serving, stats).first()
    assert (t.hour, t.report_hour) == ("2026-07-13 12:00", "20260713_12")
    b = board(serving).collect()
    assert [(x["rank"], x.tier_label, x.score_1dp, x.score_0dp, x.bar_width) for x in b] == [
        (1, "📈 VIRAL", "74.4", "74", 74.4), (2, "📈 VIRAL", "74.3", "74", 74.28)]
