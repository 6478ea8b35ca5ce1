"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every source's documents are dealt by a hash into permuted blocks of about ``BLOCK_DOCS``
documents; the mix draws whole blocks in order of that permutation (the second pass over a source
repeats it) until the source's target is reached, and cuts only the last block between documents.
The drawn blocks of all sources are split over equal output shards by a binary tree: a node with
n_s blocks of source s gives its left half a multivariate hypergeometric share of them, so every
shard's composition is distributed as in one global shuffle, while only counts are ever split.
A shard then takes the next disjoint run of each source's permuted blocks and orders its documents
by a local hash.

Everything is DataFrame functions. Groups that meet in one task: the counts by source of one tree
node (sources are a catalogue, 16 bytes each), one block, one shard. A hot source is only a longer
list of blocks, whose running sum is range-partitioned.

Cases: null text has size 0; a null source is a source of its own (last); no rows, or no words at
all, give targets of 0 and an empty mix; a source whose documents are all empty takes nothing;
rows that repeat a doc_id are told apart by source, size and content and otherwise drawn together;
columns of any name pass through (helper columns start with an underscore).
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trend_engine.llm._common import numbered, running_sum, table, word_count

#: Weights by rank of the source, repeating; share of all words to mix; highest repeat of a source.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
BLOCK_DOCS = 64
SHARD_WORDS = 4_000_000
SEED = 7


def targets(sized: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """One row (source, docs, source_size, target) per source of rows (source, size).

    Weights go by code point order of the sources, null last. A target stops at `most` times the
    source's size and what it can't take is shared again among the others by weight.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    ranked = numbered(sizes, [F.col("source").asc_nulls_last()], "_rank", "mix-sources")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int")).cast("double")
    ranked = table(ranked.withColumn("_weight", weight).withColumn("_most", most * F.col("source_size")), "mix-weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while total:  # each round fills at least one more source; the sums are over all sources
        open_ = F.col("_most") > F.col("_weight") * level
        row = ranked.agg(F.sum(F.when(open_, F.col("_weight"))).alias("w"), F.sum(F.when(~open_, F.col("_most"))).alias("m"),
                         F.sum((~open_).cast("long")).alias("n")).first()
        if row.n == full or not row.w:
            break
        full, level = row.n, (share * total - (row.m or 0.0)) / row.w
    return ranked.select("source", "docs", "source_size", F.least("_most", F.col("_weight") * level).alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST, block_docs=BLOCK_DOCS, shard_words=SHARD_WORDS,
        seed=SEED, text="text", source="source", key="doc_id") -> DataFrame:
    """The mix: the columns of `docs`, once for each time that a row is drawn, then `_copy` (from 0),
    `_shard` and `_position` (order in the shard). A column of `docs` with one of these names stays, and
    the mix's own is left out."""
    _, plan = _plan(docs, weights, share, most, block_docs, shard_words, seed, text, source, key)
    # The row travels as one value, so its columns may have any names.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(source).alias("_src"),
                       _name(text, source, key, seed).alias("_hash"))
    rows = _with_draws(rows, plan, "inner")
    rows = rows.withColumn("_draw", F.explode(_drawn())).select("_row", "_hash", "_draw._copy", "_draw._shard")
    order = F.xxhash64(F.lit(seed), "_shard", "_copy", "_hash")
    within = Window.partitionBy("_shard").orderBy(order, "_hash", "_copy")
    rows = rows.withColumn("_position", F.row_number().over(within) - 1)
    return rows.select("_row.*", *[c for c in ("_copy", "_shard", "_position") if c not in docs.columns])


def taken(docs: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST, block_docs=BLOCK_DOCS, shard_words=SHARD_WORDS,
          seed=SEED, text="text", source="source", key="doc_id") -> DataFrame:
    """Per row of `docs`: doc_id, size, source_size, target, taken and the shards it went to."""
    sized, plan = _plan(docs, weights, share, most, block_docs, shard_words, seed, text, source, key)
    rows = _with_draws(sized.withColumn("_src", F.col("source")), plan, "left")
    draws = F.coalesce(_drawn(), F.array())
    return rows.select(F.col("key").alias("doc_id"), "size", F.coalesce("_source_size", F.lit(0)).alias("source_size"),
                       F.coalesce("_target", F.lit(0.0)).alias("target"), (F.col("size") * F.size(draws)).alias("taken"),
                       F.transform(draws, lambda d: d["_shard"]).alias("shards"))


def _name(text, source, key, seed) -> Column:
    """Place of a row in its source's permutation."""
    return F.xxhash64(F.lit(seed), F.col(key), F.col(source), F.length(F.col(text)), F.col(text))


def _block_of() -> Column:
    return F.pmod(F.xxhash64("_hash"), F.col("_blocks"))


def _with_draws(rows: DataFrame, plan: DataFrame, how: str) -> DataFrame:
    """Rows of (_src, _hash) with their source's figures and their block's draws. The block is made a
    column first (from the sources' numbers of blocks), so rows and blocks meet on equal keys."""
    sources = plan.select(F.col("_source").alias("_s"), F.col("_blocks").alias("_bs")).distinct()
    rows = rows.join(sources, F.col("_src").eqNullSafe(F.col("_s")), how)
    rows = rows.withColumn("_at", F.pmod(F.xxhash64("_hash"), F.col("_bs"))).drop("_s", "_bs")
    return rows.join(plan, F.col("_src").eqNullSafe(F.col("_source")) & (F.col("_at") == F.col("_block")), how)


def _drawn() -> Column:
    """The draws of a row's block that take this row."""
    return F.filter("_draws", lambda d: d["_taken"].isNull() | F.array_contains(d["_taken"], F.col("_hash")))


def _plan(docs, weights, share, most, block_docs, shard_words, seed, text, source, key) -> tuple[DataFrame, DataFrame]:
    """(rows of key, source, size, _hash; one row per block with its draws, of every source)."""
    sized = table(docs.select(F.col(key).alias("key"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
                              _name(text, source, key, seed).alias("_hash")), "mix-sizes")
    goal = table(targets(sized, weights, share, most), "mix-targets").select(
        F.col("source").alias("_source"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"),
        F.greatest(F.lit(1), F.ceil(F.col("docs") / block_docs)).cast("long").alias("_blocks"))
    rows = sized.join(goal, F.col("source").eqNullSafe(F.col("_source")))
    rows = rows.withColumn("_block", _block_of())
    blocks = rows.groupBy("_source", "_blocks", "_target", "_source_size", "_block").agg(F.sum("size").alias("_words"))
    blocks = table(running_sum(blocks, "_source", ["_block"], "_words", "_before", "mix-blocks"), "mix-blocks")
    draws = blocks.withColumn("_copy", F.explode(F.array(*[F.lit(c) for c in range(math.ceil(most))]))) \
        .withColumn("_room", F.col("_target") - F.col("_before") - F.col("_copy") * F.col("_source_size")) \
        .where("_words > 0 and _room > 0").withColumn("_cut", F.col("_words") > F.col("_room"))
    draws = draws.select("_source", "_block", "_copy", "_room", "_cut", F.lit(1).alias("_one"))
    # The position of a draw in its source, and the source's number of draws.
    draws = table(running_sum(draws, "_source", ["_copy", "_block"], "_one", "_draw", "mix-draws"), "mix-draws")
    runs = _shards(draws.groupBy("_source").agg(F.sum("_one").alias("_n")), _shard_count(goal, shard_words), seed)
    dealt = draws.join(runs, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_draw") == F.col("_d")))
    dealt = dealt.select(F.col("_source").alias("_s"), F.col("_block").alias("_b"), "_copy", "_shard", "_room", "_cut")
    # Of a source's last block, the documents that fit: the words drawn end near the target.
    cut = rows.join(dealt.where("_cut"), F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_block") == F.col("_b")))
    cut = _filled(cut.groupBy("_s", "_b", "_copy", "_shard", "_room").agg(
        F.sort_array(F.collect_list(F.struct(F.col("size").alias("_size"), "_hash")), asc=False).alias("_docs")))
    whole = dealt.where("not _cut").withColumn("_taken", F.lit(None).cast("array<long>"))
    both = whole.select("_s", "_b", "_copy", "_shard", "_taken").unionByName(cut.select("_s", "_b", "_copy", "_shard", "_taken"))
    draws_of = both.groupBy("_s", "_b").agg(F.sort_array(F.collect_list(F.struct("_copy", "_shard", "_taken"))).alias("_draws"))
    plan = blocks.join(draws_of, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_block") == F.col("_b")), "left")
    return sized, table(plan.select("_source", "_blocks", "_target", "_source_size", "_block", "_draws"), "mix-plan")


def _filled(blocks: DataFrame) -> DataFrame:
    """`_taken`: hashes of a cut block's documents that bring it nearest to `_room` words, trying
    the longest first; the shortest of the others is added if that ends nearer still."""
    def step(may):
        add = lambda acc, d: F.struct((acc["left"] - d["_size"]).alias("left"),
                                      F.concat(acc["taken"], F.array(d["_hash"])).alias("taken"))
        return lambda acc, d: F.when((d["_size"] > 0) & may(acc, d), add(acc, d)).otherwise(acc)

    fits = step(lambda acc, d: d["_size"] <= acc["left"])
    nearer = step(lambda acc, d: (d["_size"] < 2 * acc["left"]) & ~F.array_contains(acc["taken"], d["_hash"]))
    start = F.struct(F.col("_room").alias("left"), F.array().cast("array<long>").alias("taken"))
    blocks = blocks.withColumn("_fill", F.aggregate("_docs", start, fits))
    return blocks.withColumn("_taken", F.aggregate(F.reverse("_docs"), F.col("_fill"), nearer, lambda acc: acc["taken"]))


def _shard_count(goal: DataFrame, shard_words: int) -> int:
    words = goal.agg(F.sum("_target")).first()[0] or 0.0
    return max(1, math.ceil(words / shard_words))


def _shards(counts: DataFrame, shards: int, seed: int) -> DataFrame:
    """For every draw (_s, _d) its `_shard`: the splitting tree over the counts by source.

    A node holds its range of shards and how many draws of each source it has. Shard boundaries are
    the exact fractions of all draws, so shards differ by one draw at most.
    """
    node = counts.agg(F.sort_array(F.collect_list(F.struct(F.col("_source").alias("s"), F.col("_n").alias("n"),
                                                           F.lit(0).cast("long").alias("at")))).alias("_share"))
    total = F.aggregate("_share", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    node = node.select(F.lit(0).cast("long").alias("_lo"), F.lit(shards).cast("long").alias("_hi"), total.alias("_all"), "_share")
    for depth in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        mid = F.floor((F.col("_lo") + F.col("_hi")) / 2)
        edge = lambda k: F.floor(F.col("_all") * k / shards)
        node = node.withColumn("_mid", mid).withColumn("_left", F.when(F.col("_hi") - F.col("_lo") > 1,
                                                                       edge(F.col("_mid")) - edge(F.col("_lo"))))
        node = node.withColumn("_drawn", _hypergeometric_share(seed + depth))
        left = F.struct(F.col("_lo").alias("lo"), F.col("_mid").alias("hi"), F.transform(
            F.arrays_zip("_share", "_drawn"), lambda x: F.struct(
                x["_share"]["s"].alias("s"), x["_drawn"].alias("n"), x["_share"]["at"].alias("at"))).alias("share"))
        right = F.struct(F.col("_mid").alias("lo"), F.col("_hi").alias("hi"), F.transform(
            F.arrays_zip("_share", "_drawn"), lambda x: F.struct(
                x["_share"]["s"].alias("s"), (x["_share"]["n"] - x["_drawn"]).alias("n"),
                (x["_share"]["at"] + x["_drawn"]).alias("at"))).alias("share"))
        same = F.struct(F.col("_lo").alias("lo"), F.col("_hi").alias("hi"), F.col("_share").alias("share"))
        parts = F.when(F.col("_left").isNull(), F.array(same)).otherwise(F.array(left, right))
        node = node.select("_all", F.explode(parts).alias("_part")).select(
            F.col("_part.lo").alias("_lo"), F.col("_part.hi").alias("_hi"), "_all", F.col("_part.share").alias("_share"))
        # A written table between levels: counts are drawn once, and a lost executor draws nothing anew.
        node = table(node, "mix-tree")
    leaf = node.select(F.col("_lo").alias("_shard"), F.explode("_share").alias("_x")).where("_x.n > 0")
    return leaf.select("_shard", F.col("_x.s").alias("_s"), F.explode(
        F.sequence(F.col("_x.at"), F.col("_x.at") + F.col("_x.n") - 1)).alias("_d"))


def _hypergeometric_share(seed: int) -> Column:
    """Of a node's draws, `_left` without replacement: how many of each source (array by source).

    Source by source, each given what the earlier ones took: hypergeometric with the rest.
    """
    start = F.struct(F.col("_left").alias("left"),
                     F.aggregate("_share", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("rest"),
                     F.array().cast("array<long>").alias("drawn"))

    def step(acc, x):
        uniform = (F.pmod(F.xxhash64(F.lit(seed), F.col("_lo"), F.col("_hi"), x["s"]), F.lit(1 << 52)) + 0.5) / float(1 << 52)
        got = hypergeometric(x["n"], acc["rest"] - x["n"], acc["left"], uniform)
        return _let(got, lambda n: F.struct((acc["left"] - n).alias("left"), (acc["rest"] - x["n"]).alias("rest"),
                                            F.concat(acc["drawn"], F.array(n)).alias("drawn")))

    return F.when(F.col("_left").isNotNull(), F.aggregate("_share", start, step, lambda acc: acc["drawn"]))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of the value, which stands in the plan once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def log_factorial(x: Column) -> Column:
    """ln x! by Stirling's series (from x + 8 on, errors below 1e-9)."""
    def body(x):
        y = x + 8.0
        series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * F.pow(y, F.lit(3))) \
            + 1 / (1260 * F.pow(y, F.lit(5)))
        low = F.lit(0.0)
        for k in range(1, 8):
            low = low + F.log(x + float(k))
        return series - low

    return _let(x, body)


def hypergeometric(good: Column, bad: Column, drawn: Column, uniform: Column) -> Column:
    """A hypergeometric number by inversion: `drawn` of `good + bad` without replacement, how many
    are good. Walks up from ten standard deviations (and ten) below the mean, or the lowest value."""
    given = F.struct(good.alias("good"), bad.alias("bad"), drawn.alias("drawn"), uniform.alias("uniform"))
    return _let(given, lambda g: _let(_limits(g["good"], g["bad"], g["drawn"]), lambda at: _walked(
        g["good"], g["bad"], g["drawn"], g["uniform"], at["low"], at["high"], at["highest"])))


def _limits(good: Column, bad: Column, drawn: Column) -> Column:
    """The highest number there can be, and where the walk begins and ends."""
    lowest = F.greatest(F.lit(0), drawn - bad)
    highest = F.least(good, drawn)
    total = F.greatest(good + bad, F.lit(1)).cast("double")
    mean = drawn * good / total
    spread = F.sqrt(F.greatest(F.lit(0.0), mean * (bad / total) * ((total - drawn) / F.greatest(total - 1, F.lit(1.0)))))
    low = F.greatest(lowest, F.floor(mean - 10 * spread - 10)).cast("long")
    high = F.least(highest, F.ceil(mean + 10 * spread + 10)).cast("long")
    return F.struct(low.alias("low"), high.alias("high"), highest.alias("highest"))


def _walked(good: Column, bad: Column, drawn: Column, uniform: Column, low: Column, high: Column, highest: Column) -> Column:
    choose = lambda n, k: log_factorial(n) - log_factorial(k) - log_factorial(n - k)
    first = F.exp(choose(good, low) + choose(bad, drawn - low) - choose(good + bad, drawn))
    start = _let(first, lambda p: F.struct(low.alias("x"), p.alias("p"), p.alias("sum")))

    def step(acc, k):
        x = acc["x"]
        p = acc["p"] * ((good - x) * 1.0) * (drawn - x) / ((x + 1.0) * (bad - drawn + x + 1))
        return F.when(acc["sum"] >= uniform, acc).otherwise(_let(p, lambda p: F.struct((x + 1).alias("x"), p.alias("p"), (acc["sum"] + p).alias("sum"))))

    walked = F.aggregate(F.sequence(low + 1, high), start, step, lambda acc: acc["x"])
    return F.when(low >= high, highest.cast("long")).otherwise(walked)


def op7_mixing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return taken(docs).select("doc_id", "size", "source_size", "target", "taken")
