"""Phrase collocations by weighted acyclic automata.

A transducer here accepts phrases word by word and gives their count. It is kept level by level: the
states of a level in the order of their phrases, each with its parent, the word that leads to it and the
weight (count) of what passes through it. `step` is the one operation on it: from given parents over
given words to the states of the next level, where equal pairs meet and weights add up.

1. Every task turns a shard (about `SHARD` words) into a transducer of its sorted n-grams, level by
   level (`build`). A first pass takes words and pairs, a second one three to five words, and only where
   all pairs inside are frequent: a phrase is never more frequent than its parts, so nothing is lost.
   The frequent pairs reach the second pass as a Bloom filter of at most 8 MB, whose false
   positives only add phrases that fall out later.
2. Shard transducers are cut at common bounds into prefix ranges (of about `RANGE` shard paths, so a hot
   word or pair is spread over many), each range is the `union` of its pieces: states that agree meet,
   their weights add up. Bounds come from at most `SAMPLES` sampled paths; they only spread the work. States
   on a range's first or last path may go on in the next range: their weights are added up in Spark.
3. Phrases of at least `least` form the count transducers of sorted ranges. The parts of candidates (all
   cuts) are dealt to the ranges that may hold them, in batches; a batch is a small transducer of its
   own, and its composition with the range's (`compose`) gives the counts of all its parts at once.
4. Scores are exact (whole numbers in 38 digits); each group's best `top` are kept by rank.

Cases: null text is empty, a null group is `und`; words are whatever stands between blanks; rows
that repeat count again; texts of any length are cut whole; an empty table gives an empty result; only
the text and group columns are read, so others may have any names. Equal scores go to the more frequent
phrase, then to the smaller one in UTF-8 byte order.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trend_engine.llm import _hashing as H
from trend_engine.llm._common import table
from trend_engine.llm._text import classes, cut, portions

LONGEST, LEAST, TOP = 5, 100, 2000
UNKNOWN = "und"
#: Words in a shard; shard paths in a prefix range; sampled paths (for bounds only).
SHARD, RANGE, SAMPLES = 1_200_000, 2_000_000, 100_000
#: Bits of the filter per frequent pair, and the largest filter (8 MB).
BITS, MOST_BITS = 16, 1 << 26
#: Phrases in a count transducer; parts in a batch.
PHRASES, BATCH = 100_000, 50_000
KINDS = classes(b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d")
#: Label of the arc that ends a phrase (it sorts before all words).
END = -1


@dataclass
class Transducer:
    """`words` are the labels' texts in byte order; level k has `parent[k]`, `label[k]`, `weight[k]`."""

    words: list[bytes]
    parent: list[np.ndarray]
    label: list[np.ndarray]
    weight: list[np.ndarray]

    def pack(self) -> bytes:
        bounds = np.cumsum([0, *map(len, self.words)])
        parts = [np.array([len(self.parent), len(self.words)], np.int64), bounds.astype(np.int64)]
        for p, l, w in zip(self.parent, self.label, self.weight, strict=True):
            parts += [np.array([len(p)], np.int64), np.diff(p, prepend=0).astype(np.int32), l.astype(np.int32), w.astype(np.int64)]
        return zstandard.ZstdCompressor(level=1).compress(b"".join([*(x.tobytes() for x in parts), *self.words]))

    @staticmethod
    def unpack(data: bytes) -> Transducer:
        raw, at = zstandard.ZstdDecompressor().decompress(data), 0

        def take(n: int, kind) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, n, at)
            at += out.nbytes
            return out

        levels, n = take(2, np.int64).tolist()
        bounds = take(n + 1, np.int64).tolist()
        t = Transducer([], [], [], [])
        for _ in range(levels):
            size = int(take(1, np.int64)[0])
            t.parent.append(np.cumsum(take(size, np.int32), dtype=np.int64))
            t.label.append(take(size, np.int32).astype(np.int64))
            t.weight.append(take(size, np.int64))
        t.words = [raw[at + a : at + b] for a, b in zip(bounds, bounds[1:], strict=False)]
        return t

    def path(self, leaf: int) -> tuple[bytes, ...]:
        """The words that lead to a state of the last level."""
        out = []
        for p, l in zip(reversed(self.parent), reversed(self.label), strict=True):
            if l[leaf] != END:
                out.append(self.words[l[leaf]])
            leaf = int(p[leaf])
        return tuple(reversed(out))

    def find(self, path: tuple[bytes, ...]) -> int:
        """Number of last-level states whose phrase is smaller than `path`."""
        lo, hi = 0, 1
        for k, (p, l) in enumerate(zip(self.parent, self.label, strict=True)):
            a, b = np.searchsorted(p, [lo, hi])
            want = bisect.bisect_left(self.words, path[k]) if k < len(path) else END
            hit = k >= len(path) or (want < len(self.words) and self.words[want] == path[k])
            lo = a + int(np.searchsorted(l[a:b], want))
            hi = lo + int(hit and lo < b and l[lo] == want)
            if lo == hi or not hit:
                for q in self.parent[k + 1 :]:
                    lo = int(np.searchsorted(q, lo))
                return lo
        return lo

    def piece(self, a: int, b: int) -> Transducer:
        """The paths to the last-level states a to b, with their own words."""
        t = Transducer([], [], [], [])
        weight = self.weight[-1][a:b]
        for p, l in zip(reversed(self.parent), reversed(self.label), strict=True):
            base = int(p[a])
            up = p[a:b] - base
            t.parent.insert(0, up)
            t.label.insert(0, l[a:b])
            t.weight.insert(0, weight)
            weight = np.add.reduceat(weight, np.searchsorted(up, np.arange(int(up[-1]) + 1)))
            a, b = base, base + int(up[-1]) + 1
        used = np.unique(np.concatenate(t.label))
        used = used[used != END]
        code = np.full(len(self.words) + 1, END)
        code[used] = np.arange(len(used))
        t.words = [self.words[i] for i in used.tolist()]
        t.label = [code[l] for l in t.label]
        return t


def step(parent: np.ndarray, label: np.ndarray, weight: np.ndarray | None, size: int) -> tuple[np.ndarray, ...]:
    """The next level: (parent, label, weight) of its states, and the state each row comes to."""
    key, state, n = np.unique(parent * (size + 1) + label + 1, return_inverse=True, return_counts=True)
    if weight is not None:
        order = np.argsort(state, kind="stable")
        n = np.add.reduceat(weight[order], np.cumsum(n) - n) if len(n) else weight
    return key // (size + 1), key % (size + 1) - 1, n, state


def build(words: list[bytes], columns: list[np.ndarray], weight: np.ndarray | None = None) -> Transducer:
    """The transducer of rows of labels (one column per level, END where a phrase is over)."""
    t, state = Transducer(words, [], [], []), np.zeros(len(columns[0]), np.int64)
    for c in columns:
        parent, label, n, state = step(state, c, weight, len(words))
        t.parent.append(parent)
        t.label.append(label)
        t.weight.append(n)
    return t


def union(parts: list[Transducer]) -> Transducer:
    """The transducer that gives the sum of what the parts give."""
    words = sorted(set().union(*(p.words for p in parts)))
    code = {w: k for k, w in enumerate(words)}
    maps = [np.array([*(code[w] for w in p.words), END], np.int64) for p in parts]
    t, states = Transducer(words, [], [], []), [np.zeros(1, np.int64) for _ in parts]
    for k in range(len(parts[0].parent)):
        parent = np.concatenate([s[p.parent[k]] for s, p in zip(states, parts, strict=True)])
        label = np.concatenate([m[p.label[k]] for m, p in zip(maps, parts, strict=True)])
        weight = np.concatenate([p.weight[k] for p in parts])
        up, to, n, state = step(parent, label, weight, len(words))
        t.parent.append(up)
        t.label.append(to)
        t.weight.append(n)
        states = np.split(state, np.cumsum([len(p.parent[k]) for p in parts])[:-1])
    return t


def compose(ask: Transducer, counts: Transducer) -> np.ndarray:
    """What `counts` gives for every path of `ask` (in path order; 0 where it has none)."""
    code = {w: k for k, w in enumerate(counts.words)}
    # A word unknown to `counts` gets a label beyond all of its own.
    to = np.array([*(code.get(w, len(code)) for w in ask.words), END], np.int64)
    at, size = np.zeros(1, np.int64), len(code) + 1
    for k in range(len(ask.parent)):
        have = counts.parent[k] * (size + 1) + counts.label[k] + 1
        up = at[ask.parent[k]]
        want = up * (size + 1) + to[ask.label[k]] + 1
        i = np.minimum(np.searchsorted(have, want), len(have) - 1)
        at = np.where((up >= 0) & (have[i] == want), i, -1)
    return np.where(at >= 0, counts.weight[-1][at], 0)


# ---- shards ---------------------------------------------------------------------------------------

def _pair_bits(group: np.ndarray, a: np.ndarray, b: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two places of a pair in a filter of `bits` (a power of two)."""
    h = H.mix(H.mix(group + a) ^ (b * np.uint64(0x9E3779B97F4A7C15)))
    return h & np.uint64(bits - 1), (h >> np.uint64(32)) & np.uint64(bits - 1)


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)


def _windows(code: np.ndarray, piece: np.ndarray, size: int, joined: np.ndarray | None) -> list[np.ndarray]:
    """For each word, itself and the words after it, END beyond its piece or a pair not `joined`."""
    n = len(code)
    on = piece[1:] == piece[:-1] if n else np.zeros(0, bool)
    if joined is not None:
        on = on & joined
    out, go = [code], np.ones(n, bool)
    for k in range(1, size):
        go = np.concatenate([go[: n - k] & on[k - 1 :], np.zeros(min(k, n), bool)]) if n > k - 1 else go
        go = go[:n]
        out.append(np.where(go, np.concatenate([code[k:], np.full(min(k, n), END)]), END))
    return out


def _shards(docs: DataFrame, size: int, filter_: tuple | None) -> DataFrame:
    """One row per shard: its transducer of n-grams of `size` words (shorter ones at the ends of
    pieces), the number of its paths and some of them, evenly spaced."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count = 0
        for part in portions(batches, 0, 1 << 23):
            code, words, row, piece = cut(part.column(0), KINDS)
            lang = part.column(1).dictionary_encode()
            held.append((code, words, lang.indices.to_numpy()[row], lang.dictionary.cast(pa.binary()), piece))
            count += len(code)
            if count >= SHARD:
                yield from shard(held)
                held, count = [], 0
        if count:
            yield from shard(held)

    def shard(held):
        words = pa.concat_arrays([x for h in held for x in (h[1].cast(pa.binary()), h[3])]).unique()
        words = words.take(pc.sort_indices(words))
        code, lang, piece, base = [], [], [], 0
        for c, w, g, names, p in held:
            code.append(pc.index_in(w, value_set=words).to_numpy().astype(np.int64)[c])
            lang.append(pc.index_in(names, value_set=words).to_numpy().astype(np.int64)[g])
            piece.append(p + base)
            base += int(p[-1]) + 1 if len(p) else 0
        code, lang, piece = map(np.concatenate, (code, lang, piece))
        names = words.to_pylist()
        joined = None
        if filter_:
            h, bits = _word_hashes(names), np.frombuffer(filter_[0].value, np.uint8)
            joined = np.ones(max(len(code) - 1, 0), bool)
            for place in _pair_bits(h[lang[:-1]], h[code[:-1]], h[code[1:]], filter_[1]):
                joined &= (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        columns = _windows(code, piece, size, joined)
        if filter_:
            keep = columns[2] != END
            columns, lang = [c[keep] for c in columns], lang[keep]
        if not len(lang):
            return
        t = build(names, [lang, *columns])
        n = len(t.parent[-1])
        paths = [list(t.path(i)) for i in range(0, n, max(1, n // 50))]
        yield pa.RecordBatch.from_arrays([pa.array([t.pack()], pa.binary()), pa.array([n]),
                                          pa.array([paths], pa.list_(pa.list_(pa.binary())))], ["data", "n", "paths"])

    return docs.mapInArrow(run, "data binary, n long, paths array<array<binary>>")


def _bounds(shards: DataFrame) -> list[tuple[bytes, ...]]:
    """Paths that split all shard paths into ranges of about `RANGE`; from a bounded sample."""
    total, rows = shards.agg(F.sum("n"), F.sum(F.size("paths"))).first()
    ranges = -(-(total or 0) // RANGE)
    if ranges < 2:
        return []
    each = shards.select((F.col("n") / F.size("paths")).alias("w"), F.explode("paths").alias("p"))
    if rows > SAMPLES:
        each = each.sample(SAMPLES / rows, seed=1)
    found = sorted((tuple(map(bytes, r.p)), r.w) for r in each.collect())
    ends = np.cumsum([w for _, w in found])
    cuts = np.searchsorted(ends, ends[-1] * np.arange(1, ranges) / ranges)
    return sorted({found[i][0] for i in cuts.tolist()})


def _counts(shards: DataFrame, least: int, sizes: range) -> DataFrame:
    """(group, phrase, size, f) of the union of the shards: phrases of `sizes` words (0: all words of the
    group). Complete where f >= least; smaller ones are partial or left out."""
    bounds = _bounds(shards)

    def cuts(batches):
        for batch in batches:
            for data in batch.column(0):
                t = Transducer.unpack(data.as_py())
                at = [0, *(t.find(b) for b in bounds), len(t.parent[-1])]
                k = [i for i in range(len(at) - 1) if at[i] < at[i + 1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k, pa.int32()), pa.array([t.piece(at[i], at[i + 1]).pack() for i in k], pa.binary())], ["k", "data"])

    def together(pieces: pa.Table) -> pa.Table:
        whole, held, n = None, [], 0
        for data in pieces.column("data"):
            held.append(Transducer.unpack(data.as_py()))
            n += len(held[-1].parent[-1])
            if n > RANGE // 2:
                whole, held, n = union([*([whole] if whole else []), *held]), [], 0
        t = union([*([whole] if whole else []), *held]) if held else whole
        names = np.array(t.words, object)
        group, phrase, size, f = [], [], [], []
        lang, text = names[t.label[0]], np.full(len(t.label[0]), b"", object)
        for k in range(len(t.parent)):
            if k:
                lang = lang[t.parent[k]]
                text = text[t.parent[k]]
                real = t.label[k] != END
                more = np.full(len(real), b"", object)
                more[real] = names[t.label[k][real]]
                text = text + (b" " if k > 1 else b"") + more
            # The first and the last path may go on in the neighbouring ranges.
            keep = t.weight[k] >= least
            keep[[0, -1]] = True
            keep &= t.label[k] != END
            if k in sizes:
                group += lang[keep].tolist()
                phrase += text[keep].tolist()
                size += [k] * int(keep.sum())
                f += t.weight[k][keep].tolist()
        return pa.table({"grp": pa.array(group, pa.binary()).cast(pa.string()), "phrase": pa.array(phrase, pa.binary()).cast(pa.string()),
                         "size": pa.array(size, pa.int32()), "f": pa.array(f, pa.int64())})

    pieces = shards.select("data").mapInArrow(cuts, "k int, data binary")
    parts = pieces.groupBy("k").applyInArrow(together, "grp string, phrase string, size int, f long")
    return parts.groupBy("grp", "phrase", "size").agg(F.sum("f").alias("f"))


def _pair_filter(pairs: DataFrame) -> tuple:
    """A Bloom filter over the frequent pairs: (broadcast bytes, number of bits)."""
    bits = 1 << 16
    n = pairs.count()
    while bits < min(BITS * n, MOST_BITS):
        bits *= 2

    def run(batches):
        for batch in batches:
            group = _word_hashes([s.encode() for s in batch.column(0).to_pylist()])
            two = [s.encode().split(b" ") for s in batch.column(1).to_pylist()]
            places = _pair_bits(group, _word_hashes([t[0] for t in two]), _word_hashes([t[1] for t in two]), bits)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(places).astype(np.int64))], ["place"])

    cells = pairs.select("grp", "phrase").mapInArrow(run, "place long").groupBy(F.shiftright("place", 5).alias("cell")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place & 31 as int))")).alias("v"))
    out = np.zeros(bits // 32, np.uint32)
    found = cells.toArrow()
    out[found.column(0).to_numpy()] = found.column(1).to_numpy().astype(np.uint32)
    return pairs.sparkSession.sparkContext.broadcast(out.tobytes()), bits


# ---- phrases ---------------------------------------------------------------------------------------

def frequent(docs: DataFrame, text: str, group: str, longest: int, least: int) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to `longest` words with at least `least` occurrences (grp, phrase, size, f), as a
    written table, and the number of words of each group (grp, n)."""
    plain = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
                        F.coalesce(F.col(group).cast("string"), F.lit(UNKNOWN)).alias("grp"))
    short = table(_counts(table(_shards(plain, 2, None), "shards"), least, range(3)), "phrase-counts")
    enough = short.where(F.col("f") >= least)
    long = enough.where("size > 0")
    if longest > 2:
        filter_ = _pair_filter(enough.where("size = 2"))
        more = _counts(table(_shards(plain, longest, filter_), "shards"), least, range(3, longest + 1))
        long = table(long.unionByName(more.where(F.col("f") >= least)), "phrases")
    return long, short.where("size = 0").select("grp", F.col("f").alias("n"))


def _key(grp: Column | str, phrase: Column | str) -> Column:
    # Hexadecimal digits: the group's name may hold blanks itself.
    return F.concat_ws(" ", F.hex(grp), phrase)


def part_counts(phrases: DataFrame, parts: DataFrame) -> DataFrame:
    """`parts` (key, and any other columns) with the count `f` of the phrase of that key (group and words
    joined by blanks), looked up by composing batches of parts with the count transducers."""
    ranges = max(1, -(-phrases.count() // PHRASES))
    columns = [c for c in parts.columns if c != "key"]

    def transducer(keys: list[str], weight: np.ndarray) -> tuple[Transducer, np.ndarray]:
        rows = [k.encode().split(b" ") for k in keys]
        words = sorted({w for r in rows for w in r})
        code = {w: i for i, w in enumerate(words)}
        # Group and words, and an end after the longest phrase.
        grid = np.full((len(rows), LONGEST + 2), END, np.int64)
        for i, r in enumerate(rows):
            grid[i, : len(r)] = [code[w] for w in r]
        t = build(words, list(grid.T), weight)
        state = np.zeros(len(rows), np.int64)
        for k in range(grid.shape[1]):
            have = t.parent[k] * (len(words) + 1) + t.label[k]
            state = np.searchsorted(have, state * (len(words) + 1) + grid[:, k])
        return t, state

    def counts(batches):
        both = [b for b in batches if b.num_rows]
        if both:
            t = pa.Table.from_batches(both)
            keys = t.column(0).to_pylist()
            whole, _ = transducer(keys, t.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array([min(keys, key=str.encode)]), pa.array([whole.pack()], pa.binary())], ["low", "data"])

    keyed = phrases.select(_key("grp", "phrase").alias("key"), "f")
    held = table(keyed.repartitionByRange(ranges, "key").mapInArrow(counts, "low string, data binary"), "count-transducers")
    lows = sorted((r.low.encode(), i) for i, r in enumerate(held.select("low").collect()))
    starts = [b for b, _ in lows]

    def deal(batches):
        for batch in batches:
            keys = batch.column("key").to_pylist()
            k = np.array([bisect.bisect_right(starts, x.encode()) - 1 for x in keys], np.int64)
            for r in np.unique(k[k >= 0]).tolist():
                rows = batch.take(pa.array(np.flatnonzero(k == r)))
                for a in range(0, rows.num_rows, BATCH):
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, rows.schema) as w:
                        w.write_batch(rows.slice(a, BATCH))
                    yield pa.RecordBatch.from_arrays([pa.array([starts[r].decode()]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["low", "rows"])

    def answers(batches):
        for batch in batches:
            for rows, data in zip(batch.column("rows"), batch.column("data"), strict=True):
                ask = pa.ipc.open_stream(rows.as_py()).read_all().combine_chunks()
                t, state = transducer(ask.column("key").to_pylist(), np.zeros(ask.num_rows, np.int64))
                f = compose(t, Transducer.unpack(data.as_py()))[state]
                for out in ask.select(columns).append_column("f", pa.array(f)).to_batches():
                    yield out

    asked = parts.select(*columns, "key").mapInArrow(deal, "low string, rows binary")
    schema = ", ".join(f"`{c}` {parts.schema[c].dataType.simpleString()}" for c in columns) + ", f long"
    return asked.join(held, "low").select("rows", "data").mapInArrow(answers, schema)


def collocations(docs: DataFrame, text: str = "text", group: str = "lang", longest: int = LONGEST, least: int = LEAST,
                 top: int = TOP) -> DataFrame:
    """Each group's first `top` phrases: lang, rank, phrase, a, l, r, n, score."""
    if longest > LONGEST:
        raise ValueError(f"phrases have at most {LONGEST} words")
    phrases, totals = frequent(docs, text, group, longest, least)
    candidates = phrases.where("size > 1").select("grp", "phrase", "size", F.col("f").alias("a"))
    words = F.split("phrase", " ")
    cuts = candidates.select("grp", "phrase", "size", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    first = F.array_join(F.slice(words, 1, F.col("k")), " ")
    rest = F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ")
    sides = F.explode(F.array(F.struct(F.lit(True).alias("left"), first.alias("part")), F.struct(F.lit(False).alias("left"), rest.alias("part"))))
    asked = cuts.select("grp", "phrase", "size", "a", "k", sides.alias("s")).select(
        "grp", "phrase", "size", "a", "k", "s.left", "s.part", _key("grp", "s.part").alias("key"))
    found = table(part_counts(phrases, asked), "part-counts")
    both = found.groupBy("grp", "phrase", "a", "k").agg(F.max(F.when(F.col("left"), F.col("f"))).alias("l"),
                                                        F.max(F.when(~F.col("left"), F.col("f"))).alias("r"))
    # A part of one word less that is as frequent as the candidate stands inside it; longer reaches follow
    # from that step by step, as counts only fall with length.
    inside = found.where("f = a").where("(left AND k = size - 1) OR (NOT left AND k = 1)").where("size > 2") \
        .select("grp", F.col("part").alias("phrase")).distinct()
    # Whole numbers of 18 digits: their products stay exact within 38.
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    thousand = (F.col("a") * 1000).cast("decimal(18,0)")
    score = (thousand * wide("n")), (wide("l") * wide("r"))
    scored = both.join(totals, "grp").select("grp", "phrase", "a", "n", "k", "l", "r", score[0].alias("over"), score[1].alias("under")) \
        .withColumn("score", F.expr("over div under"))
    best = scored.groupBy("grp", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    best = best.join(inside, ["grp", "phrase"], "left_anti")
    order = Window.partitionBy("grp").orderBy(F.desc("b.score"), F.desc("a"), F.asc("phrase"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(F.col("grp").alias("lang"), F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("b.l").alias("l"),
                         F.col("b.r").alias("r"), "n", F.col("b.score").cast("long").alias("score"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))
