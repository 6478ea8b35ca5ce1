"""Sources and sinks: landed items, CSV raw table, ORC hourly table, report files, serving fallback."""

import datetime as dt
import glob
import json
import os

from pyspark.sql import functions as F

from trend_engine import fixtures
from trend_engine.operators.aggregates import hourly_rollup
from trend_engine.plans import reports
from trend_engine.plans.serving import save_snapshot, stats_response, trending_response
from trend_engine.session import scratch_dir
from trend_engine.sources import catalog, rollup
from trend_engine.sources.items import LANDED_FIELDS, land_items, normalise_items, read_items
from trend_engine.sources.outputs import read_reports, write_analytics, write_report
from trend_engine.streaming.ingest import ViralSink
from trend_engine.sources.messages import parse_posts

from conftest import SF_SMALL


def test_landed_items_round_trip(spark):
    work = scratch_dir(spark, "items")
    items = fixtures.raw_items(spark, SF_SMALL)
    land_items(items, f"{work}/items")
    back = read_items(spark, f"{work}/items", extra_fields=LANDED_FIELDS)
    a = sorted(tuple(r) for r in normalise_items(back).collect())
    b = sorted(tuple(r) for r in normalise_items(items).collect())
    assert a == b and len(a) > 0


def test_csv_raw_table_keeps_commas(spark):
    work = scratch_dir(spark, "csv")
    posts = fixtures.posts(spark, SF_SMALL).withColumn(
        "title", F.when(F.col("batch") == 1, F.lit('a, b "quoted"')).otherwise(F.col("title")))
    catalog.append_raw_posts(posts, f"{work}/raw")
    back = catalog.raw_posts(spark, f"{work}/raw")
    assert back.count() == posts.count()
    assert back.filter(F.col("title") == 'a, b "quoted"').count() == posts.filter("batch = 1").count()
    catalog.register(spark, {"raw_posts": back})
    assert spark.sql("SELECT count(*) FROM viral_posts_view").first()[0] == posts.filter("viral_score > 50").count()


def test_orc_hourly_rewrite_is_idempotent(spark):
    work = scratch_dir(spark, "orc")
    roll = hourly_rollup(fixtures.posts(spark, SF_SMALL))
    catalog.write_hourly(roll, f"{work}/hourly")
    catalog.write_hourly(roll.filter("hour_bucket < '2024-01-02'"), f"{work}/hourly")
    assert catalog.hourly(spark, f"{work}/hourly").count() == roll.count()


def test_report_files_keyed_by_hour(spark):
    work = scratch_dir(spark, "reports")
    p = fixtures.posts(spark, SF_SMALL)
    rep = reports.trend_report(fixtures.serving_from_posts(p), fixtures.stats_from_posts(p))
    write_report(rep, f"{work}/reports")
    write_report(rep, f"{work}/reports")  # same hour again: replaced, not duplicated
    key = rep.first().report_hour
    assert os.path.isdir(f"{work}/reports/report_hour={key}")
    assert spark.read.json(f"{work}/reports").count() == 1
    write_analytics(reports.analytics_report(fixtures.serving_from_posts(p), fixtures.stats_from_posts(p)),
                    f"{work}/analytics")
    got = spark.read.json(f"{work}/analytics").first()
    assert len(got.top_posts) == 5


def test_serving_live_cached_empty(spark):
    work = scratch_dir(spark, "serve")
    # empty: no store, no snapshot
    e = trending_response(spark, f"{work}/none", None).first()
    assert (e.source, e.total_viral_posts, e.trending) == ("empty", 0, [])
    s = stats_response(spark, f"{work}/none", None).first()
    assert (s.source, s.pipeline_health, s.total_viral_posts) == ("empty", "CACHED", 0)
    # cached: a saved payload
    os.makedirs(f"{work}/snap", exist_ok=True)
    with open(f"{work}/snap/trending.json", "w") as f:
        json.dump({"generated_at": "2026-07-13T12:23:42.733006-04:00", "total_viral_posts": 2,
                   "pipeline_stats": {"total_processed": "30"},
                   "trending": [{"id": "1", "title": "x", "score": 5, "comments": 1, "viral_score": 74.4,
                                 "author": "a", "source": "hackernews"}]}, f)
    c = trending_response(spark, f"{work}/none", f"{work}/snap/trending.json").first()
    assert (c.source, c.total_viral_posts, c.trending[0].viral_score) == ("cached", 2, 74.4)
    # live: a store written by the stream sink
    os.makedirs(f"{work}/chk", exist_ok=True)
    with open(f"{work}/chk/metadata", "w") as f:
        f.write('{"id":"00000000-0000-0000-0000-000000000002"}\n')
    msgs = [json.dumps({"id": str(i), "title": f"t{i}", "score": 10, "comments": 1, "author": "a", "source": "s",
                        "subreddit": "x", "viral_score": 60.0 + i, "is_viral": True,
                        "timestamp": "2024-01-01T00:00:00.000000", "unix_time": 1, "batch": 1}) for i in range(25)]
    ViralSink(f"{work}/store", f"{work}/chk")(parse_posts(spark.createDataFrame([(m,) for m in msgs], "value string")), 0)
    live = trending_response(spark, f"{work}/store", f"{work}/snap/trending.json").first()
    assert live.source == "live" and live.total_viral_posts == 25 and len(live.trending) == 20
    assert live.trending[0].id == "24"
    assert abs(dt.datetime.fromisoformat(live.generated_at) - dt.datetime.now(dt.timezone.utc)) < dt.timedelta(minutes=5)
    st = stats_response(spark, f"{work}/store").first()
    assert (st.source, st.total_processed, st.viral_detected, st.peak_viral_score) == ("live", "25", "25", 84.0)


AWKWARD = ["plain", "", None, " two  blanks ", "a,b", 'say "hi"', '"', "line\nend", "car\rriage", "back\\slash", "\\N", "100%", "%0A",
           "tab\there", "ünï 日本", "''", "trailing\\"]


def _titled(spark):
    one = fixtures.posts(spark, SF_SMALL).where("batch = 1 AND list_rank = 0").first()
    rows = [one.asDict() | {"id": str(i), "title": t} for i, t in enumerate(AWKWARD)]
    return spark.createDataFrame(rows, fixtures.posts(spark, SF_SMALL).schema)


def test_awkward_titles_come_back(spark):
    path = f"{scratch_dir(spark, 'awkward')}/raw"
    catalog.append_raw_posts(_titled(spark), path)
    back = {int(r.id): r.title for r in catalog.raw_posts(spark, path).collect()}
    assert [back[i] for i in range(len(AWKWARD))] == AWKWARD


def _names(spark, database, kind):
    return {r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect() if not r.isTemporary} if kind == "tables" else \
        {r.viewName for r in spark.sql(f"SHOW VIEWS IN {database}").collect() if not r.isTemporary}


def test_catalog_objects_by_name_alone(spark):
    root = scratch_dir(spark, "catalog")
    for _ in range(2):  # creating them again changes nothing
        catalog.create_catalog(spark, "trend_test", root)
    assert {"raw_lines", "hourly_stats"} <= _names(spark, "trend_test", "tables")
    assert _names(spark, "trend_test", "views") == {"raw_posts", "topic_leaderboard", "viral_posts_view"}
    catalog.insert_raw(spark, "trend_test", _titled(spark))
    rows = spark.sql("SELECT id, title FROM trend_test.raw_posts").collect()
    assert {int(r.id): r.title for r in rows} == dict(enumerate(AWKWARD))
    catalog.insert_raw(spark, "trend_test", _titled(spark))  # inserts append
    assert spark.table("trend_test.raw_posts").count() == 2 * len(AWKWARD)
    # the same files through the reader without a catalog
    assert catalog.raw_posts(spark, f"{root}/raw_lines").count() == 2 * len(AWKWARD)
    spark.sql("DROP DATABASE trend_test CASCADE")


def test_catalog_hourly_replaces_days(spark):
    root = scratch_dir(spark, "catalog")
    catalog.create_catalog(spark, "trend_hours", root)
    roll = hourly_rollup(fixtures.posts(spark, SF_SMALL))
    catalog.insert_hourly(spark, "trend_hours", roll)
    day = roll.selectExpr("substring(hour_bucket, 1, 10) d").first().d
    catalog.insert_hourly(spark, "trend_hours", roll.where(F.col("hour_bucket").startswith(day)).limit(1))
    left = spark.table("trend_hours.hourly_stats")
    assert left.where(F.col("day") == day).count() == 1
    assert left.count() == roll.where(~F.col("hour_bucket").startswith(day)).count() + 1
    spark.sql("DROP DATABASE trend_hours CASCADE")


def test_unreadable_store_falls_back_when_read(spark):
    work = scratch_dir(spark, "broken")
    os.makedirs(f"{work}/chk")
    with open(f"{work}/chk/metadata", "w") as f:
        f.write('{"id":"00000000-0000-0000-0000-000000000003"}\n')
    msg = json.dumps({"id": "1", "title": "t", "score": 10, "comments": 1, "author": "a", "source": "s", "subreddit": "x",
                      "viral_score": 60.0, "is_viral": True, "timestamp": "2024-01-01T00:00:00.000000", "unix_time": 1, "batch": 1})
    ViralSink(f"{work}/store", f"{work}/chk")(parse_posts(spark.createDataFrame([(msg,)], "value string")), 0)
    live, figures = trending_response(spark, f"{work}/store"), stats_response(spark, f"{work}/store")
    assert (live.first().source, figures.first().source) == ("live", "live")
    save_snapshot(live, f"{work}/trending")
    save_snapshot(figures, f"{work}/stats")
    for p in glob.glob(f"{work}/store/viral_posts/bucket=*/*.parquet"):
        with open(p, "r+b") as f:
            f.truncate(os.path.getsize(p) // 2)
    cached = trending_response(spark, f"{work}/store", f"{work}/trending").first()
    assert (cached.source, cached.total_viral_posts, cached.trending[0].id) == ("cached", 1, "1")
    assert stats_response(spark, f"{work}/store", f"{work}/stats").first().source == "cached"
    assert trending_response(spark, f"{work}/store").first().source == "empty"
    # a snapshot that is no response is passed over, too
    os.makedirs(f"{work}/bad")
    with open(f"{work}/bad/x.json", "w") as f:
        f.write("not json")
    assert trending_response(spark, f"{work}/store", f"{work}/bad").first().source == "empty"


def test_report_files_are_read_by_hour(spark):
    root = scratch_dir(spark, "reports")
    p = fixtures.posts(spark, SF_SMALL)
    serving, stats = fixtures.serving_from_posts(p), fixtures.stats_from_posts(p)
    hours = [dt.datetime(2024, 7, 1, h, 30) for h in (12, 13)]
    for at in hours:
        write_report(reports.trend_report(serving, stats, now=at), root)
    write_report(reports.trend_report(serving.limit(3), stats, now=hours[0]), root)
    got = {r.report_hour: r.total_viral_posts for r in read_reports(spark, root).collect()}
    assert got == {"20240701_08": 3, "20240701_09": serving.count()}
    one = read_reports(spark, root, ["20240701_08"])
    assert one.count() == 1
    assert "report_hour" in one._jdf.queryExecution().executedPlan().toString().split("PartitionFilters:")[1].split("]")[0]


def test_rollup_reads_new_epochs_and_touched_days_only(spark):
    work = scratch_dir(spark, "rollup")
    p = fixtures.posts(spark, SF_SMALL)
    days = sorted(r.d for r in p.selectExpr("date_format(observed_at, 'yyyy-MM-dd') d").distinct().collect())
    last = F.date_format("observed_at", "yyyy-MM-dd") == days[-1]
    for epoch, part in enumerate((p.where("batch % 2 = 0"), p.where("batch % 2 = 1").where(last))):
        catalog.write_raw_epoch(part, f"{work}/raw", "r", epoch)
        stamps = {f: os.path.getmtime(f) for f in glob.glob(f"{work}/hours_parts/day=*/*.parquet")}
        rollup.roll_up(spark, f"{work}/raw", f"{work}/hours")
    kept = set(stamps) & set(glob.glob(f"{work}/hours_parts/day=*/*.parquet"))
    assert {os.path.basename(os.path.dirname(f)) for f in kept} == {f"day={d}" for d in days[:-1]}
    both = p.where("batch % 2 = 0").unionByName(p.where("batch % 2 = 1").where(last))
    assert sorted(map(tuple, catalog.hourly(spark, f"{work}/hours").collect())) == sorted(map(tuple, hourly_rollup(both).collect()))
    plan = rollup.new_observations(spark, f"{work}/raw", f"{work}/hours")._jdf.queryExecution().executedPlan().toString()
    assert "epoch" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    plan = rollup.parts_of_days(spark, f"{work}/hours", days[:1])._jdf.queryExecution().executedPlan().toString()
    assert "day" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert rollup.new_observations(spark, f"{work}/raw", f"{work}/hours").count() == 0


def test_rollup_can_be_run_again_after_any_step(spark, monkeypatch):
    work = scratch_dir(spark, "rollup-fail")
    p = fixtures.posts(spark, SF_SMALL)
    catalog.write_raw_epoch(p.where("batch % 2 = 0"), f"{work}/raw", "r", 0)
    rollup.roll_up(spark, f"{work}/raw", f"{work}/hours")
    catalog.write_raw_epoch(p.where("batch % 2 = 1"), f"{work}/raw", "r", 1)

    def fail(*_):
        raise RuntimeError("injected after the partials were merged")

    with monkeypatch.context() as m:
        m.setattr(catalog, "write_hourly", fail)
        try:
            rollup.roll_up(spark, f"{work}/raw", f"{work}/hours")
            raise AssertionError("the injected failure did not come")
        except RuntimeError:
            pass
    rollup.roll_up(spark, f"{work}/raw", f"{work}/hours")
    assert sorted(map(tuple, catalog.hourly(spark, f"{work}/hours").collect())) == sorted(map(tuple, hourly_rollup(p).collect()))


def test_odd_message_times(spark):
    forms = {"2024-01-01T00:00:00.123456": "2024-01-01 00:00:00.123456", "2024-01-01T00:00": "2024-01-01 00:00:00",
             "2024-01-01 05:06:07": "2024-01-01 05:06:07", "2024-01-01T00:00:00+02:00": "2023-12-31 22:00:00",
             "2024-01-01T00:00:00Z": "2024-01-01 00:00:00", "yesterday": None, "": None, "2024": None, "2024-13-01T00:00:00": None}
    rows = [(json.dumps({"id": str(i), "timestamp": t}),) for i, t in enumerate(forms)]
    got = parse_posts(spark.createDataFrame(rows, "value string")).select("id", F.col("observed_at").cast("string")).collect()
    assert {int(r.id): r[1] for r in got} == dict(enumerate(forms.values()))
