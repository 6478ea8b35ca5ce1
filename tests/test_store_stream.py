"""Keyed store semantics, replay safety and stream = batch."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from trend_engine import fixtures
from trend_engine.operators.aggregates import windowed_topics
from trend_engine.plans.stored import arrival, resume, run_stream
from trend_engine.session import scratch_dir
from trend_engine.sources import catalog, keyed, store
from trend_engine.sources.messages import parse_posts, read_posts_stream
from trend_engine.streaming.files import land_envelopes
from trend_engine.streaming.ingest import TOPICS_SCHEMA, TopicSink, ViralSink, start_windowed_topics, topics_latest

from conftest import SF_SMALL

AVAILABLE_NOW = {"availableNow": True}


def _msg(id_, score, batch, viral=True, ts="2024-01-01T00:00:00.000000"):
    return json.dumps({"id": id_, "title": f"t{id_}-{batch}", "score": 1, "comments": 1, "author": "a",
                       "source": "s", "subreddit": "x", "viral_score": score, "is_viral": viral,
                       "timestamp": ts, "unix_time": 1, "batch": batch})


def _sink(spark):
    work = scratch_dir(spark, "unit")
    os.makedirs(f"{work}/chk", exist_ok=True)
    with open(f"{work}/chk/metadata", "w") as f:
        f.write('{"id":"00000000-0000-0000-0000-000000000001"}\n')
    return work, ViralSink(f"{work}/store", f"{work}/chk")


def _batch(spark, msgs, offsets=None):
    rows = [(m, 0, (offsets or list(range(len(msgs))))[i]) for i, m in enumerate(msgs)]
    raw = spark.createDataFrame(rows, "value string, partition int, offset long")
    return parse_posts(raw)


def test_cooled_post_stays_and_later_offset_wins(spark):
    work, sink = _sink(spark)
    sink(_batch(spark, [_msg("1", 80.0, 1), _msg("2", 60.0, 1), _msg("2", 70.0, 1)], [0, 1, 2]), 0)
    sink(_batch(spark, [_msg("1", 40.0, 2, viral=False)]), 1)
    latest = {r.id: r for r in store.viral_latest(spark, f"{work}/store").collect()}
    assert latest["1"].viral_score == 80.0 and latest["1"].batch_num == 1
    assert latest["2"].viral_score == 70.0
    stats = {r.stat_key: r.stat_value for r in store.stats_latest(spark, f"{work}/store").collect()}
    assert stats == {"total_processed": "1", "viral_detected": "0", "last_batch_time": "1"}


def test_replayed_epoch_replaces_itself(spark):
    work, sink = _sink(spark)
    b = _batch(spark, [_msg("1", 80.0, 1), _msg("2", 90.0, 1)])
    sink(b, 0)
    sink(b, 0)  # at-least-once replay of the same epoch
    assert store.viral_table(spark, f"{work}/store").count() == 2
    c = store.cumulative_counts(spark, f"{work}/store").first()
    assert (c.total_processed, c.viral_detected, c.batches) == (2, 2, 1)


def test_empty_batch_writes_nothing_and_null_id_rejected(spark):
    work, sink = _sink(spark)
    sink(_batch(spark, []), 0)
    assert store.stats_latest(spark, f"{work}/store").count() == 0
    sink(_batch(spark, [_msg(None, 99.0, 1), _msg("7", 99.0, 1), "not json"]), 1)
    assert [r.id for r in store.viral_latest(spark, f"{work}/store").collect()] == ["7"]
    assert store.rejects(spark, f"{work}/store").count() == 1
    stats = {r.stat_key: r.stat_value for r in store.stats_latest(spark, f"{work}/store").collect()}
    assert stats["total_processed"] == "3" and stats["viral_detected"] == "2"


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_equals_batch_and_restart_resumes(spark):
    posts = fixtures.posts(spark, SF_SMALL)
    work = scratch_dir(spark, "streamtest")
    for low, high in ((1, 9), (9, 17), (17, 25), (25, 10 ** 6)):
        run_stream(spark, work, posts.where((F.col("batch") >= low) & (F.col("batch") < high)), arrival())
    got = store.viral_latest(spark, f"{work}/store")
    want = fixtures.serving_from_posts(posts)
    assert _sorted(got) == _sorted(want.select(*got.columns))
    c = store.cumulative_counts(spark, f"{work}/store").first()
    assert c.total_processed == posts.count() and c.batches == 4
    assert store.viral_table(spark, f"{work}/store").select("run").distinct().count() == 1
    resume(spark, work)  # nothing new: nothing changes
    assert store.cumulative_counts(spark, f"{work}/store").first() == c


def test_table_holds_one_row_per_key_in_its_bucket(spark):
    work, sink = _sink(spark)
    root = f"{work}/store"
    for epoch in range(3):
        sink(_batch(spark, [_msg(str(i), 60.0 + epoch, epoch + 1) for i in range(epoch * 10, epoch * 10 + 30)]), epoch)
    rows = store.viral_table(spark, root).select("id", "bucket", "epoch", store.bucket_of("id").alias("want")).collect()
    assert len(rows) == len({r.id for r in rows}) == 50
    assert all(r.bucket == r.want for r in rows)
    assert {r.epoch for r in rows if int(r.id) >= 20} == {2}
    # a batch of one key rewrites one bucket only
    before = {p: os.path.getmtime(p) for p in glob.glob(f"{root}/viral_posts/bucket=*/*.parquet")}
    sink(_batch(spark, [_msg("7", 99.0, 4)]), 3)
    after = set(glob.glob(f"{root}/viral_posts/bucket=*/*.parquet"))
    gone = {os.path.dirname(p) for p in set(before) - after}
    assert len(gone) == 1 and len(after) == len(before)


def test_reads_prune_by_bucket_and_column(spark):
    work, sink = _sink(spark)
    root = f"{work}/store"
    sink(_batch(spark, [_msg(str(i), 60.0 + i, 1) for i in range(100)]), 0)
    df = store.viral_posts_by_id(spark, root, ["3", "41"])
    assert sorted(r.id for r in df.collect()) == ["3", "41"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "bucket" in filters
    narrow = store.viral_latest(spark, root, ["viral_score"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in narrow and "title" not in narrow.split("ReadSchema:")[1]


def test_totals_and_rejects_survive_replays_and_restarts(spark):
    work, sink = _sink(spark)
    root = f"{work}/store"
    batches = [_batch(spark, [_msg(None, 90.0, e + 1), _msg(str(e), 80.0, e + 1), _msg("x", 10.0, e + 1, viral=False)]) for e in range(5)]
    for e, b in enumerate(batches):
        sink(b, e)
    def figures():
        c = store.cumulative_counts(spark, root).first()
        return c.total_processed, c.viral_detected, c.rejected, c.batches, store.rejects(spark, root).count()
    assert figures() == (15, 10, 5, 5, 5)
    sink(batches[4], 4)
    sink(batches[3], 3)  # an even older epoch: still nothing added
    assert figures() == (15, 10, 5, 5, 5)
    # a lost checkpoint starts a new run whose epochs count from zero again
    os.makedirs(f"{work}/chk2")
    with open(f"{work}/chk2/metadata", "w") as f:
        f.write('{"id":"00000000-0000-0000-0000-000000000002"}\n')
    ViralSink(root, f"{work}/chk2")(batches[0], 0)
    assert figures() == (18, 12, 6, 6, 6)
    assert store.ledger(spark, root).count() == 2  # one row per run and block of epochs


def test_ledger_blocks_add_up(spark, monkeypatch):
    monkeypatch.setattr(store, "BLOCK", 2)
    work, sink = _sink(spark)
    for e in range(5):
        sink(_batch(spark, [_msg(str(e), 80.0, e + 1)]), e)
    assert store.ledger(spark, f"{work}/store").count() == 3
    assert store.cumulative_counts(spark, f"{work}/store").first().batches == 5
    stats = {r.stat_key: r.stat_value for r in store.stats_latest(spark, f"{work}/store").collect()}
    assert stats["last_batch_time"] == "4"


def test_counter_restart_in_one_batch_follows_offsets(spark):
    work, sink = _sink(spark)
    sink(_batch(spark, [_msg("1", 80.0, 9), _msg("1", 70.0, 1)], [5, 6]), 0)
    assert store.viral_latest(spark, f"{work}/store").first().viral_score == 70.0


def test_insert_time_is_available(spark):
    work, sink = _sink(spark)
    sink(_batch(spark, [_msg("1", 80.0, 1)]), 0)
    r = store.viral_latest(spark, f"{work}/store", ["timestamp", "ingested_at"]).first()
    assert r.timestamp.year == 2024 and r.ingested_at > r.timestamp


def test_lost_bucket_is_rebuilt_from_the_raw_table(spark):
    posts = fixtures.posts(spark, SF_SMALL)
    work = scratch_dir(spark, "rebuild")
    run_stream(spark, work, posts, arrival(), raw_path=f"{work}/raw")
    root = f"{work}/store"
    want = _sorted(store.viral_latest(spark, root))
    # what a driver lost inside the commit can leave: an empty bucket
    lost = store.viral_table(spark, root).where("bucket = 3").limit(0)
    assert lost.count() == 0
    for p in glob.glob(f"{root}/viral_posts/bucket=3/*.parquet"):
        os.remove(p)
    assert len(_sorted(store.viral_latest(spark, root))) < len(want)
    store.rebuild_viral(spark, root, catalog.observations(catalog.raw_posts(spark, f"{work}/raw")))
    assert _sorted(store.viral_latest(spark, root)) == want


def test_envelopes_keep_a_key_in_one_partition(spark):
    posts = fixtures.posts(spark, SF_SMALL)
    path = scratch_dir(spark, "envelopes")
    land_envelopes(posts, path, arrival())
    back = spark.read.parquet(path)
    assert back.columns == ["key", "value", "partition", "offset"]
    assert back.groupBy("key").agg(F.count_distinct("partition").alias("n")).where("n > 1").isEmpty()
    assert back.select("offset").distinct().count() == posts.count()


def test_windowed_stream_equals_batch_and_files_do_not_grow(spark):
    posts = fixtures.posts(spark, SF_SMALL)
    work = scratch_dir(spark, "topics")
    files = []
    for k in range(3):
        run_stream(spark, work, posts.where(F.col("list_rank") % 3 == k), arrival(), start_windowed_topics)
        files.append(len(glob.glob(f"{work}/store/topics/day=*/*.parquet")))
    got = topics_latest(spark, f"{work}/store")
    want = windowed_topics(posts).select(*got.columns)
    assert _sorted(got) == _sorted(want)
    assert files[0] == files[1] == files[2]  # all three epochs fall into the same days
    rows = [(r.topic, r.window_start) for r in got.collect()]
    assert rows == sorted(rows, key=lambda r: (r[0], -r[1].timestamp()))


def test_windowed_stream_counts_late_rows(spark):
    posts = fixtures.posts(spark, SF_SMALL)
    work = scratch_dir(spark, "topics-late")
    for part in (posts.filter("batch > 17"), posts.filter("batch <= 17")):  # the oldest rows come last
        run_stream(spark, work, part, arrival(), start_windowed_topics)
    got = topics_latest(spark, f"{work}/store")
    assert _sorted(got) == _sorted(windowed_topics(posts).select(*got.columns))


def _topic_msgs(hours):
    return [_msg(str(h), 60.0, 1, ts=f"2024-01-0{1 + h // 24}T{h % 24:02d}:10:00.000000") for h in hours]


def test_replayed_topics_add_nothing_even_after_half_a_write(spark):
    work, _ = _sink(spark)
    sink, root = TopicSink(f"{work}/store", f"{work}/chk"), f"{work}/store"
    sink(_batch(spark, _topic_msgs([1, 30])), 0)
    second = _batch(spark, _topic_msgs([1, 2, 30, 31]))
    # the first day of epoch 1 was written before the failure, the second was not
    sink(_batch(spark, _topic_msgs([1, 2])), 1)
    sink(second, 1)
    sink(second, 1)
    counts = {r.window_start.hour + 24 * (r.window_start.day - 1): r.post_count for r in topics_latest(spark, root).collect()}
    assert counts == {1: 2, 2: 1, 30: 2, 31: 1}
    table = keyed.read_table(spark, f"{root}/topics", TOPICS_SCHEMA)
    assert table.count() == 4 and {r.upto for r in table.collect()} == {1}


class _FailOnce(ViralSink):
    """A sink that dies right after writing one epoch, the first time only."""

    def __init__(self, root, checkpoint, fail_epoch):
        super().__init__(root, checkpoint)
        self.fail_epoch = fail_epoch
        self.failed = False

    def write(self, batch, run, epoch, stamp):
        super().write(batch, run, epoch, stamp)
        if epoch == self.fail_epoch and not self.failed:
            self.failed = True
            raise RuntimeError("injected failure after the epoch's writes")


def test_forced_failure_then_restart_equals_batch(spark):
    posts = fixtures.posts(spark, SF_SMALL)
    work = scratch_dir(spark, "failure")
    sink = _FailOnce(f"{work}/store", f"{work}/chk", fail_epoch=1)

    def run():
        raw = read_posts_stream(spark, fmt="parquet", path=f"{work}/input")
        q = (parse_posts(raw).writeStream.queryName("t_fail").option("checkpointLocation", f"{work}/chk")
             .foreachBatch(sink).trigger(availableNow=True).start())
        q.awaitTermination()

    for k in range(4):
        land_envelopes(posts.where(F.col("batch") % 4 == k), f"{work}/input", arrival())
        if k == 1:
            with pytest.raises(Exception):
                run()
        run()  # after the failure: restart from the checkpoint, epoch 1 is replayed
    got = store.viral_latest(spark, f"{work}/store")
    # an epoch has every fourth poll, so the latest row of an id is the one of the last epoch that had it viral
    order = F.struct(F.col("batch") % 4, "batch")
    last = posts.where("is_viral").groupBy("id").agg(F.max_by(F.struct("title", "batch"), order).alias("p"))
    assert sorted((r.id, r.title, r.batch_num) for r in got.collect()) == sorted((r.id, r.p.title, r.p.batch) for r in last.collect())
    c = store.cumulative_counts(spark, f"{work}/store").first()
    assert c.total_processed == posts.count() and c.batches == 4
