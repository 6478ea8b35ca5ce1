"""Property tests: decay monotonicity, flag = rounded > 50, latest-per-key is order-free."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from trend_engine.functions.scoring import is_viral, viral_score
from trend_engine.operators.latest import latest_per_key

NOW = 1_700_000_000.0


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 50_000), st.integers(0, 5_000), st.integers(3600, 400 * 3600), st.integers(1, 7200))
def test_score_non_increasing_with_age(spark, score, comments, age, extra):
    df = spark.createDataFrame([(score, comments, int(NOW) - age, NOW), (score, comments, int(NOW) - age - extra, NOW)],
                               "score int, comments int, unix_time long, now double")
    a, b = [r[0] for r in df.select(viral_score("score", "comments", "unix_time", "now")).collect()]
    assert b <= a


@settings(max_examples=25, deadline=None)
@given(st.lists(st.floats(0, 200, allow_nan=False), min_size=1, max_size=20))
def test_flag_is_rounded_score_above_50(spark, values):
    df = spark.createDataFrame([(round(v, 2),) for v in values], "viral_score double")
    for s, v in df.select("viral_score", is_viral("viral_score")).collect():
        assert v == (s > 50)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abcde"), st.integers(0, 10**6)), min_size=1, max_size=60, unique_by=lambda t: t[1]),
       st.integers(0, 10**6))
def test_latest_per_key_order_free(spark, rows, seed):
    shuffled = rows[:]
    random.Random(seed).shuffle(shuffled)
    a = spark.createDataFrame(rows, "k string, o long").repartition(3)
    b = spark.createDataFrame(shuffled, "k string, o long").repartition(5)
    want = {}
    for k, o in rows:
        want[k] = max(want.get(k, -1), o)
    for df in (a, b):
        got = {r.k: r.o for r in latest_per_key(df.selectExpr("k", "o", "o AS v"), ["k"], ["o"], ["v", "o"]).collect()}
        assert got == want


@settings(max_examples=20, deadline=None)
@given(st.lists(st.integers(0, 100_000), min_size=1, max_size=40), st.integers(1, 6))
def test_exact_cents_mean_is_half_up_and_partition_free(spark, cents, parts):
    from decimal import ROUND_HALF_UP, Decimal

    from trend_engine.functions.exact import mean_exact, mean_round2
    df = spark.createDataFrame([(c / 100,) for c in cents], "viral_score double").repartition(parts)
    r = df.agg(mean_round2("viral_score").alias("r2"), mean_exact("viral_score").alias("m")).first()
    exact = Decimal(sum(cents)) / Decimal(100 * len(cents))
    assert r.r2 == float(exact.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))
    assert r.m == sum(cents) / (100 * len(cents))
