"""Timing of the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``:
one warm-up, then the median of ``$BENCH_REPS`` (default 3) runs, each fully executed into
Spark's ``noop`` sink (no collect to the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trend_engine.plans.registry import QUERIES  # noqa: E402
from trend_engine.session import build_session  # noqa: E402

HEADLINE = [
    "viral_score", "tier_distribution", "author_leaderboard", "topic_leaderboard", "top_viral_posts",
    "poll_summary", "hourly_rollup", "windowed_topics", "viral_posts_latest", "stats_summary",
    "trending_board", "trending_payload", "trend_report", "analytics_report", "parse_posts",
    "normalise_items",
]
STREAM = ["stream_viral_latest"]  # a full stream replay into a fresh store per run


BUILD = {}


def _run(spark, name, sf_dir):
    t0 = time.perf_counter()
    df = QUERIES[name](spark, sf_dir)
    t1 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    t2 = time.perf_counter()
    BUILD.setdefault(name, []).append(t1 - t0)
    return t2 - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          extra={"spark.driver.memory": "8g"})
    times = {}
    for name in HEADLINE + STREAM:
        _run(spark, name, sf_dir)
        times[name] = round(statistics.median(_run(spark, name, sf_dir) for _ in range(reps)), 4)
    sf = sf_dir.rsplit("sf", 1)[-1]
    out = {"metric": "headline_queries_total", "value": round(sum(times.values()), 4), "unit": "sec",
           "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
           "cpus": cpus, "reps": reps,
           # time inside the query function before its DataFrame is returned (median): plan
           # building on the driver; for stream queries it also includes running the stream
           "build_sec": {k: round(statistics.median(v), 4) for k, v in BUILD.items()}}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
