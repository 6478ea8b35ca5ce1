"""End to end through the job entry points: items → produce → ingest → analytics → report → hourly → rebuild."""

from trend_engine import fixtures, jobs
from trend_engine.plans.produce import messages_from_items
from trend_engine.session import scratch_dir
from trend_engine.sources import store
from trend_engine.sources.items import land_items

from conftest import SF_SMALL


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_items_to_report(spark):
    work = scratch_dir(spark, "jobs")
    items = fixtures.raw_items(spark, SF_SMALL)
    land_items(items, f"{work}/items")
    jobs.produce(spark, f"{work}/items", f"{work}/messages", "file", {})
    jobs.ingest(spark, "file", f"{work}/messages", {}, f"{work}/store", f"{work}/chk", once=True,
                raw_path=f"{work}/raw_posts")
    serving = store.viral_latest(spark, f"{work}/store")
    want = fixtures.serving_from_posts(messages_from_items(items))
    assert _sorted(serving.drop("timestamp")) == _sorted(want.select(*serving.columns).drop("timestamp"))
    jobs.analytics(spark, f"{work}/store", f"{work}/analytics")
    assert spark.read.json(f"{work}/analytics").count() == 1
    jobs.report(spark, f"{work}/store", f"{work}/reports")
    assert spark.read.json(f"{work}/reports").first().total_viral_posts == serving.count()
    jobs.rebuild(spark, f"{work}/raw_posts", f"{work}/rebuilt")
    assert _sorted(store.viral_latest(spark, f"{work}/rebuilt")) == _sorted(serving)
    # every observation reached the raw table; the hourly job rolls it into ORC
    jobs.hourly(spark, f"{work}/raw_posts", f"{work}/hourly")
    from trend_engine.operators.aggregates import hourly_rollup
    from trend_engine.sources.catalog import hourly
    assert _sorted(hourly(spark, f"{work}/hourly")) == _sorted(hourly_rollup(messages_from_items(items)))


def test_produce_streams_items_and_numbers_polls(spark):
    work = scratch_dir(spark, "produce")
    items = fixtures.raw_items(spark, SF_SMALL)
    land_items(items.where("batch = 1").drop("batch"), f"{work}/items")
    for _ in range(2):  # the second run finds nothing new
        jobs.produce(spark, f"{work}/items", f"{work}/out", "file", {}, head=10, batch=5, checkpoint=f"{work}/chk", once=True)
    sent = spark.read.parquet(f"{work}/out")
    want = messages_from_items(items.where("batch = 1"), 10)
    assert sent.count() == want.count() > 0
    assert {r[0] for r in sent.selectExpr("get_json_object(value, '$.batch')").collect()} == {"5"}
