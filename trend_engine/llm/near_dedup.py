"""Near-duplicate documents: SetSketch registers, banding, likelihood estimate, exact check.

1. Every document becomes the set of its distinct word shingles (64-bit hashes). Equal sets are one
   class, whatever their number; only classes go on.
2. A class has ``M`` SetSketch registers: for each register the smallest of the exponentially
   distributed hash values of its shingles, kept as a truncated power of ``BASE``. Registers of a
   union are the register-wise maxima, so sketches merge.
3. ``BANDS`` bands of ``ROWS`` registers make buckets. A pair at the threshold 0.8 shares none with
   probability (1 - 0.8^5)^48 = 5e-9.
4. First every member of a bucket is compared with the bucket's centre, a line of links instead of all
   pairs: the maximum-likelihood estimate of the Jaccard similarity, then an exact comparison of the
   full sets. Then the buckets that still hold several groups: members outside a bucket's largest
   group are compared with the others, tile by tile, by estimate and on their full sets, and a tile gives
   back the links that join its groups. Rejected pairs never leave a task. So every pair of a
   bucket is compared or already in one group, and only confirmed links make components.

Cases: null or blank text has no shingles and is linked with nothing; fewer words than a shingle
are one shingle; rows that repeat a doc_id and its text are one class (each is its own component's
member, all with the smallest doc_id); a null doc_id gets no component and is kept; an empty table
gives an empty result; extra columns are not read, helper columns live in tables of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trend_engine.llm import _hashing as H
from trend_engine.llm._common import components, table

#: Registers: number, base of the scale, rate of the exponential values. Bands: number, registers each.
M, BASE, RATE = 240, 1.001, 20.0
BANDS, ROWS = 48, 5
#: Registers used for the estimate, and its allowance in standard errors below the threshold.
SEEN, ERRORS = 160, 4.5
#: Halvings of the interval in the search for the most likely similarity.
STEPS = 12
WIDTH, PERCENT = 5, 80
#: Members of a bucket that are compared in one piece (a larger bucket is tiled over tasks).
TILE = 1024

_MULTIPLIERS = H.mix(np.arange(1, M + 1, dtype=np.uint64)).astype(np.uint32) | np.uint32(1)


def registers(values: np.ndarray) -> np.ndarray:
    """The SetSketch registers (uint16) of one set of 64-bit hashes."""
    x = (values >> np.uint64(32)).astype(np.uint32)
    low = np.full(M, np.iinfo(np.uint32).max, np.uint32)
    for k in range(0, len(x), 512):
        low = np.minimum(low, (x[k : k + 512, None] * _MULTIPLIERS).min(0))
    exponential = -np.log1p(-(low.astype(float) + 0.5) / 2**32) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / math.log(BASE)), 0, 65535).astype(np.uint16)


def estimate(x: np.ndarray, y: np.ndarray, n_x: np.ndarray, n_y: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs (rows of registers) with known set sizes.

    From how often a register of one side is above, below or equal to the other's.
    """
    up, down = (x > y).sum(1), (x < y).sum(1)
    same = x.shape[1] - up - down
    u, v = n_x / (n_x + n_y), n_y / (n_x + n_y)
    c, scale = (BASE - 1) / BASE, math.log(BASE)
    low, high, limit = np.zeros(len(up)), np.ones(len(up)), np.minimum(u / v, v / u)
    for _ in range(STEPS):  # the likelihood is concave: its slope tells the side of the maximum
        share = (low + high) / 2
        above, below = (1 - c * np.clip(q, 1e-12, 1) for q in (u - v * share * limit, v - u * share * limit))
        a, b = -np.log(above) / scale, -np.log(below) / scale
        to_a, to_b = -v * c / above / scale, -u * c / below / scale
        rises = up * to_a / a + down * to_b / b - same * (to_a + to_b) / np.maximum(1 - a - b, 1e-12) > 0
        low, high = np.where(rises, share, low), np.where(rises, high, share)
    return (low + high) / 2 * limit


def lowest(percent: int) -> float:
    """Estimates below this are given up: the threshold less ERRORS standard errors."""
    j = percent / 100
    return j - ERRORS * math.sqrt(j * (1 - j) / SEEN)


def _sets(batch: pa.RecordBatch, text: int, width: int) -> list[np.ndarray]:
    texts = [t or b"" for t in pc.ascii_lower(batch.column(text)).cast(pa.binary()).to_pylist()]
    out: list[np.ndarray] = []
    for a, b in H.chunks(texts):
        hashes, owner, _ = H.words(texts[a:b])
        out += H.shingles(hashes, owner, b - a, width)
    return out


def _node(values: np.ndarray) -> int:
    """64-bit name of a set."""
    total = H.mix(np.array([values.sum(dtype=np.uint64), np.bitwise_xor.reduce(values), len(values)], np.uint64))
    return int(H.mix(np.array([total.sum(dtype=np.uint64)], np.uint64)).view(np.int64)[0])


def sketches(docs: DataFrame, width: int, text: str, key: str) -> DataFrame:
    """doc_id, n_shingles, node (name of the set, null if empty), regs (registers)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = _sets(batch, 1, width)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_node(s) if len(s) else None for s in sets], pa.int64()),
                pa.array([registers(s).tobytes() if len(s) else None for s in sets], pa.binary())],
                names=["doc_id", "n_shingles", "node", "regs"])

    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(key), F.col(text).cast("string")).mapInArrow(
        run, f"doc_id {kind}, n_shingles long, node long, regs binary")


def _set_rows(rows: DataFrame, width: int) -> DataFrame:
    """node, n, members (sorted 64-bit hashes) of rows (node, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, nodes = _sets(batch, 1, width), batch.column(0).to_pylist()
            own = [(k, s) for k, s in zip(nodes, sets, strict=True) if len(s) and _node(s) == k]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in own], pa.int64()),
                                              pa.array([len(s) for _, s in own], pa.int64()),
                                              pa.array([s.tobytes() for _, s in own], pa.binary())],
                                             names=["node", "n", "members"])

    return rows.mapInArrow(run, "node long, n long, members binary")


def _band_keys(classes: DataFrame) -> DataFrame:
    """key, node: one row per band and class. Bytes of a band's registers, hashed with its number."""
    part = lambda i: F.xxhash64(i, F.substring("regs", F.lit(1) + i * (2 * ROWS), F.lit(2 * ROWS)))
    return classes.select("node", F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), part)).alias("key"))


def _buckets(keys: DataFrame) -> DataFrame:
    """key, node, size: the buckets of two members or more, each set of members once."""
    # Names of the sets of members: neither the xor nor a sum of 32 bits overflows at any size of a bucket.
    named = F.xxhash64("node")
    full = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.bit_xor(named).alias("_xor"),
                                   F.sum(named.bitwiseAND(F.lit(0xFFFFFFFF))).alias("_sum"))
    once = full.where("size > 1").groupBy("size", "_xor", "_sum").agg(F.min("key").alias("key"))
    return keys.join(once.select("key", "size"), "key").select("key", "node", "size")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b, ok: whether the full sets of each pair reach the threshold."""
    @F.pandas_udf("boolean")
    def reaches(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for p, q in zip(x, y, strict=True):
            p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
            both = len(np.intersect1d(p, q, assume_unique=True))
            out.append(100 * both >= percent * (len(p) + len(q) - both))
        return pd.Series(out, dtype=bool)

    left = sets.select(F.col("node").alias("a"), F.col("members").alias("_x"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("_y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", reaches("_x", "_y").alias("ok"))


def _likely(pairs: DataFrame, regs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose estimate doesn't rule the threshold out."""
    floor = lowest(percent)

    @F.pandas_udf("boolean")
    def may(x: pd.Series, y: pd.Series, n_x: pd.Series, n_y: pd.Series) -> pd.Series:
        a, b = (np.frombuffer(b"".join(s), np.uint16).reshape(len(s), -1) for s in (x, y))
        return pd.Series(estimate(a, b, n_x.to_numpy(float), n_y.to_numpy(float)) >= floor)

    left = regs.select(F.col("node").alias("a"), F.col("n").alias("_n"), F.col("seen").alias("_x"))
    right = regs.select(F.col("node").alias("b"), F.col("n").alias("_m"), F.col("seen").alias("_y"))
    near = F.least("_n", "_m") * 100 >= F.greatest("_n", "_m") * percent
    return pairs.join(left, "a").join(right, "b").where(near).where(may("_x", "_y", "_n", "_m")).select("a", "b")


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _between(mixed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b: links between different groups of one bucket, enough of them to join all groups that are linked.

    `mixed`: key, node, comp, size, small (outside the bucket's largest group), smalls (how many).
    Every pair of different groups is compared through its registers and, where these don't rule the
    threshold out, on its full sets, unless earlier links of the tile have joined its groups. Only the links
    that join groups leave the task: fewer than the tile has members, however many pairs are rejected.
    """
    floor = lowest(percent)
    wide = F.greatest(F.ceil(F.col("size") / TILE), F.lit(1)).cast("int")
    tall = F.greatest(F.ceil(F.col("smalls") / TILE), F.lit(1)).cast("int")
    rows = mixed.withColumn("_col", F.pmod(F.xxhash64("node"), wide).cast("int")) \
        .withColumn("_row", F.pmod(F.xxhash64("node"), tall).cast("int"))
    as_right = F.transform(F.sequence(F.lit(0), tall - 1), lambda i: F.struct(i.alias("i"), F.col("_col").alias("j")))
    as_left = F.transform(F.sequence(F.lit(0), wide - 1), lambda j: F.struct(F.col("_row").alias("i"), j.alias("j")))
    tiles = F.when(F.col("small"), F.array_union(as_right, as_left)).otherwise(as_right)
    rows = rows.withColumn("_tile", F.explode(tiles)).select(
        "key", F.col("_tile.i").alias("i"), F.col("_tile.j").alias("j"), "node", "comp", "small",
        (F.col("small") & (F.col("_row") == F.col("_tile.i"))).alias("l"), (F.col("_col") == F.col("_tile.j")).alias("r"))
    rows = rows.join(sets, "node").select("key", "i", "j", "node", "comp", "small", "l", "r", "n", "seen", "members")

    def tile(g: pd.DataFrame) -> Iterator[tuple[int, int]]:
        regs_, n = np.frombuffer(b"".join(g["seen"]), np.uint16).reshape(len(g), -1), g["n"].to_numpy()
        node, small, is_right = g["node"].to_numpy(), g["small"].to_numpy(), g["r"].to_numpy()
        members = g["members"].to_numpy()
        # Groups of the tile, joined as links are found: `group[i]` is the current group of row i.
        group = np.unique(g["comp"].to_numpy(), return_inverse=True)[1]
        width = regs_.shape[1]
        for a in np.flatnonzero(g["l"].to_numpy()):
            # Two rows outside the largest group meet in two tiles: one of them does.
            b = np.flatnonzero(is_right & (group != group[a]) & (100 * np.minimum(n, n[a]) >= percent * np.maximum(n, n[a]))
                               & (~small | (node > node[a])))
            b = b[(regs_[b] == regs_[a]).sum(1) >= (floor - 0.03) * width]
            if not len(b):
                continue
            likely = estimate(np.broadcast_to(regs_[a], (len(b), width)), regs_[b], np.full(len(b), float(n[a])), n[b].astype(float))
            b, likely = b[likely >= floor], likely[likely >= floor]
            mine = np.frombuffer(members[a], np.uint64)
            for k in b[np.lexsort((node[b], -likely))].tolist():
                if group[k] == group[a]:
                    continue
                both = len(np.intersect1d(mine, np.frombuffer(members[k], np.uint64), assume_unique=True))
                if 100 * both >= percent * (int(n[a]) + int(n[k]) - both):
                    group[group == group[k]] = group[a]
                    yield min(int(node[a]), int(node[k])), max(int(node[a]), int(node[k]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for last, batch in _with_last(batches):
            rows_ = pa.Table.from_batches([batch]).to_pandas()
            rows_ = rows_ if kept is None else pd.concat([kept, rows_], ignore_index=True)
            name = rows_[["key", "i", "j"]].to_numpy()
            new = np.flatnonzero((name[1:] != name[:-1]).any(1)) + 1
            cuts = [0, *new.tolist()] + [len(rows_)] * last
            kept = None if last else rows_.iloc[cuts[-1]:]
            out = [link for p, q in zip(cuts[:-1], cuts[1:], strict=True) for link in tile(rows_.iloc[p:q])]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(2)], names=["a", "b"])

    # A set number of partitions: tiles are small in bytes and would be merged into few tasks.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j", "node").mapInArrow(run, "a long, b long")


def _with_last(batches):
    before = None
    for b in batches:
        if b.num_rows == 0:
            continue
        if before is not None:
            yield False, before
        before = b
    if before is not None:
        yield True, before


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id, kept, class_id: one row per row of `docs`.

    component_id is the smallest doc_id reachable over links of Jaccard similarity `percent` / 100
    or more between shingle sets of `width` words; class_id names the set itself (null if empty).
    """
    own = table(sketches(docs, width, text, key), "near-sketches")
    slim = own.select("doc_id", "node").where("node is not null and doc_id is not null")
    classes = own.where("node is not null and doc_id is not null").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.min("n_shingles").alias("n"), F.min("regs").alias("regs"))
    # Buckets, then the registers of the classes that are in any.
    buckets = table(_buckets(_band_keys(classes.select("node", "regs"))), "near-buckets")
    inside = buckets.select("node").distinct()
    regs = table(classes.join(inside, "node", "left_semi").select(
        "node", "doc_id", "n", F.substring("regs", 1, 2 * SEEN).alias("seen")), "near-registers")
    texts = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    wanted = texts.join(regs.select("doc_id", "node"), "doc_id").select("node", "text")
    sets = table(_set_rows(wanted, width).dropDuplicates(["node"]) if _repeats(own) else _set_rows(wanted, width), "near-sets")
    regs = regs.select("node", "n", "seen")

    centre = buckets.groupBy("key").agg(F.min("node").alias("c"))
    stars = buckets.join(centre, "key").where("node <> c").select(*_ordered(F.col("node"), F.col("c"))).distinct()
    tested = table(_confirmed(_likely(stars, regs, percent), sets, percent), "near-links")
    links = tested.where("ok").select("a", "b")
    groups = components(links, "near-groups")
    more = table(_between(_mixed(buckets, groups), sets.join(regs.select("node", "seen"), "node"), percent), "near-between")
    if not more.isEmpty():
        groups = components(links.unionByName(more), "near-groups")
    lowest_id = slim.join(groups, "node").groupBy("component").agg(F.min("doc_id").alias("lowest"))
    by_node = groups.join(lowest_id, "component").select("node", "lowest")
    alone = slim.groupBy("node").agg(F.min("doc_id").alias("own"))
    named = alone.join(by_node, "node", "left").select(F.col("node").alias("class_id"), F.coalesce("lowest", "own").alias("c"))
    out = own.select("doc_id", "n_shingles", F.col("node").alias("class_id")).join(named, "class_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), "class_id")


def _repeats(own: DataFrame) -> bool:
    """Whether a doc_id stands on several rows."""
    return not own.groupBy("doc_id").count().where("count > 1").isEmpty()


def _mixed(buckets: DataFrame, groups: DataFrame) -> DataFrame:
    """Members of the buckets that hold several groups, with what `_between` needs."""
    rows = buckets.join(groups, "node", "left").select("key", "node", "size", F.coalesce("component", "node").alias("comp"))
    rows = table(rows, "near-mixed")
    counts = rows.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    most = counts.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("top"), F.count(F.lit(1)).alias("groups"))
    most = most.where("groups > 1").select("key", F.col("top.comp").alias("_top"), F.col("top.n").alias("_n"))
    return rows.join(most, "key").select("key", "node", "comp", "size", (F.col("comp") != F.col("_top")).alias("small"),
                                         (F.col("size") - F.col("_n")).alias("smalls"))


def op8_near_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs, width=4).select("doc_id", "n_shingles", "component_id", "kept")
