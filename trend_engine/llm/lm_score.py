"""Language-model scores: masked pseudo-likelihood of a bidirectional window network.

Each word is predicted from the ``SIDE`` words on either side of it. The vocabulary comes from counts
over the whole corpus: three quarters of the codes belong to the most frequent words, the others share
the rest by hash. There are base * base codes; the base is the fourth root of the number of distinct words
(``BASE`` at least), so classes and network grow with the corpus. A code has two digits of that base; the
network gives the first digit's probabilities and, given the first, the second's: 2 base outputs a word.
A word that shares its code has the code's probability times its share of the code's count, from the
table of all words' counts: that table grows with the corpus, stays in Spark and is joined there.

Texts are cut once, in segments of ``SEGMENT`` bytes: a written table holds every document's words as numbers of
its segment's own dictionary. The dictionaries, not the texts, are counted and joined with the counts;
a second table then holds every document's codes, which training and scoring read.

Network (numpy): gated sum of the neighbours' embeddings, tanh, two softmax layers. Training is data
parallel over all documents: every partition runs Adagrad from the same start over its own words,
and the weights are averaged by Spark, weighted by words (``ROUNDS`` times). Only the averaged
network, as large as its base says, comes to the driver.

A document's score is the sum of the log-probabilities of its words given both sides. A word that
the counts don't have (of another corpus) counts as one of its code that was seen once.

Cases: words stand between ASCII blanks and control characters of the lower-case text; null and blank texts
have no words and score 0 (mean null); one word alone is predicted from padding; repeated rows score alike;
no rows give no rows and an untrained network; extra columns are not read. Sums of doubles in another
order differ in their last digits: scores are rounded.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trend_engine.llm._common import table
from trend_engine.llm._text import classes, cut, portions

#: The smallest network's base, and its codes; neighbours on either side; width of an embedding.
BASE, SIDE, WIDTH = 32, 2, 16
SIZE = BASE * BASE
ROUNDS, RATE, BATCH, SEED = 1, 0.1, 4_096, 4
#: Bytes of text in a segment (a longer text is one of its own), and words that are coded at a time.
SEGMENT, _HELD = 8_000_000, 64 * BATCH
_PAD = SIZE  # the code beyond a text's ends
_KINDS = classes(b"\x20\x09\x0a\x0b\x0c\x0d\x1c\x1d\x1e\x1f")


def packed(numbers: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """One binary value per row: its numbers' lowest bytes, then the next ones and so on, which compress
    well and pass through Spark as one value each."""
    raw = numbers.astype("<i4").view(np.uint8).reshape(-1, 4)
    return pa.array([raw[a:b].T.tobytes() for a, b in itertools.pairwise(offsets.tolist())], pa.binary())


def unpacked(rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, offsets) of `packed` rows."""
    bounds = np.frombuffer(rows.buffers()[1], np.int32)[rows.offset : rows.offset + len(rows) + 1].astype(np.int64) if len(rows) else np.zeros(1, np.int64)
    offsets = (bounds - bounds[0]) // 4
    out = np.empty((offsets[-1], 4), np.uint8)
    if len(out):
        raw = np.frombuffer(rows.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
        for a, b in itertools.pairwise(offsets.tolist()):
            out[a:b] = raw[4 * a : 4 * b].reshape(4, -1).T
    return out.reshape(-1).view("<i4"), offsets


def segments(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Every document's words as numbers (seg, key, ids), and one row per segment with the words behind the
    numbers and how often each occurs (seg, words, counts), as one written table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = TaskContext.get().partitionId() << 32
        for part in portions(batches, 1, SEGMENT):
            keys, texts = part.columns
            ids, words, row, _ = cut(texts, _KINDS)
            n = len(texts)
            offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))])
            numbers = packed(ids, offsets)
            names = ["seg", "key", "ids", "words", "counts"]
            strings, longs = pa.list_(pa.string()), pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, seg)), keys, numbers, pa.nulls(n, strings), pa.nulls(n, longs)], names=names)
            own = pa.array(np.bincount(ids, minlength=len(words)).astype(np.int64))
            ends = pa.array([0, len(words)], pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array([seg]), pa.nulls(1, keys.type), pa.nulls(1, numbers.type),
                                              pa.ListArray.from_arrays(ends, words.cast(pa.string())), pa.ListArray.from_arrays(ends, own)], names=names)
            seg += 1

    kind = docs.select(key).schema[0].dataType.simpleString()
    rows = docs.select(key, F.lower(F.col(text).cast("string")))
    return table(rows.mapInArrow(run, f"seg long, key {kind}, ids binary, words array<string>, counts array<long>"), "lm-segments", "zstd")


def _entries(segs: DataFrame) -> DataFrame:
    """seg, pos, w, n: the segments' dictionaries, an entry a row."""
    rows = segs.where("words is not null").select("seg", F.posexplode(F.arrays_zip("words", "counts")).alias("pos", "e"))
    return rows.select("seg", "pos", F.col("e.words").alias("w"), F.col("e.counts").alias("n"))


def word_counts(segs: DataFrame) -> DataFrame:
    """w, n: the count of every word of all texts, as a written table."""
    return table(_entries(segs).groupBy("w").agg(F.sum("n").alias("n")), "lm-words", "zstd")


def base_for(distinct: int) -> int:
    """The network's base for a number of distinct words."""
    return max(BASE, math.ceil(distinct ** 0.25))


def vocabulary(counts: DataFrame, known: int) -> list[tuple[str, int]]:
    """(word, count) of the most frequent words; the last entry, None, has the count of all others."""
    top = [(r.w, r.n) for r in counts.orderBy(F.desc("n"), "w").limit(known).collect()]
    total = counts.agg(F.sum("n")).first()[0] or 0
    return [*top, (None, total - sum(n for _, n in top))]


def start(counts: list[int], rest: int, base: int = BASE) -> dict[str, np.ndarray]:
    """Weights before training: small embeddings, output biases from the corpus counts."""
    size = base * base
    rng = np.random.default_rng(SEED)
    n = np.full(size, 1 + rest / max(1, size - len(counts)))
    n[: len(counts)] = np.array(counts, float) + 1
    p = (n / n.sum()).reshape(base, base)
    first = p.sum(1)
    small = lambda *shape: rng.normal(0, 0.1, shape)
    net = {"embedding": small(size + 1, WIDTH), "gate": np.ones((2 * SIDE, WIDTH)), "high": small(WIDTH, base), "low": small(WIDTH, base),
           "high_bias": np.log(first), "low_bias": np.log(p / first[:, None])}
    return {k: v.astype(np.float32) for k, v in net.items()}


def flat(net: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([net[k].ravel() for k in sorted(net)])


def shaped(values: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = values[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def _softmax(x: np.ndarray) -> np.ndarray:
    """In place of `x`."""
    np.clip(x, -60, 60, out=x)  # within the range of single precision
    np.exp(x, out=x)
    x /= x @ np.ones((x.shape[1], 1), x.dtype)
    return x


def laid_out(codes: np.ndarray, lengths: np.ndarray, pad: int = _PAD) -> tuple[np.ndarray, np.ndarray]:
    """(line, at): the texts' codes in one line with SIDE codes of padding around each, and the
    positions of the words in it."""
    at = np.arange(len(codes)) + SIDE * (1 + np.repeat(np.arange(len(lengths)), lengths))
    line = np.full(len(codes) + SIDE * (len(lengths) + 1), pad, np.int32)
    line[at] = codes
    return line, at


def windows(texts: list[list[int]], pad: int = _PAD) -> tuple[np.ndarray, np.ndarray]:
    """`laid_out` of texts as lists of codes."""
    return laid_out(np.array([c for t in texts for c in t], np.int32), np.array([len(t) for t in texts], np.intp), pad)


def steps(line: np.ndarray, at: np.ndarray, size: int = BATCH) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(line, at) of `size` words at a time, with the neighbours of the first and the last."""
    for a in range(0, len(at), size):
        some = at[a : a + size]
        yield line[some[0] - SIDE : some[-1] + SIDE + 1], some - (some[0] - SIDE)


#: Distances of the neighbours.
_AWAY = [*range(-SIDE, 0), *range(1, SIDE + 1)]


def _forward(net, line, at):
    """Hidden layer, digits of the words, probabilities of the digits."""
    # Every code's embedding under every gate, looked up per neighbour and added up.
    total = np.zeros((len(at), WIDTH), np.float32)
    for k, d in enumerate(_AWAY):
        total += np.take(net["embedding"] * net["gate"][k], line[at + d], axis=0)
    h = np.tanh(total, out=total)
    high, low = np.divmod(line[at].astype(np.intp), net["high"].shape[1])
    p, q = h @ net["high"], h @ net["low"]
    p += net["high_bias"]
    q += np.take(net["low_bias"], high, axis=0)
    return h, high, low, _softmax(p), _softmax(q)


def log_probabilities(net: dict, line: np.ndarray, at: np.ndarray) -> np.ndarray:
    rows = np.arange(len(at))
    _, high, low, p, q = _forward(net, line, at)
    return np.log(np.maximum(p[rows, high], 1e-12)) + np.log(np.maximum(q[rows, low], 1e-12))


def _by_code(line: np.ndarray, at: np.ndarray, back: np.ndarray, codes: int) -> np.ndarray:
    """[code, neighbour, width]: sum of `back` over the words that have the code as that neighbour."""
    full = np.zeros((len(line) + 2 * SIDE, WIDTH))
    full[at + SIDE] = back
    cell = (line[:, None].astype(np.intp) * WIDTH + np.arange(WIDTH)).ravel()
    shifted = (full[SIDE - d : SIDE - d + len(line)].ravel() for d in _AWAY)
    sums = [np.bincount(cell, x, codes * WIDTH).reshape(-1, WIDTH) for x in shifted]
    return np.stack(sums, 1).astype(np.float32)


def train(net: dict, past: dict, line: np.ndarray, at: np.ndarray) -> None:
    """One Adagrad step on a batch of words; changes `net` and the sums of squares in `past`."""
    n, rows = np.float32(len(at)), np.arange(len(at))
    h, high, low, p, q = _forward(net, line, at)
    ones = np.take(np.eye(net["high"].shape[1], dtype=np.float32), high, axis=0)
    p[rows, high] -= 1
    q[rows, low] -= 1
    p /= n
    q /= n
    back = p @ net["high"].T
    back += q @ net["low"].T
    back *= 1 - h * h
    codes = _by_code(line, at, back, len(net["embedding"]))
    grads = {"high": h.T @ p, "low": h.T @ q, "high_bias": p.sum(0), "low_bias": ones.T @ q,
             "gate": (codes * net["embedding"][:, None, :]).sum(0), "embedding": (codes * net["gate"]).sum(1)}
    for k, g in grads.items():
        past[k] += g * g
        net[k] -= RATE * g / np.sqrt(past[k] + 1e-10)


def _code(word: str, known: int, base: int) -> Column:
    """The code of a word that shares it with others."""
    return (F.lit(known) + F.crc32(F.col(word).cast("binary")) % (base * base - known)).cast("int")


def coded(segs: DataFrame, words: tuple[str, ...], counts: DataFrame, base: int) -> DataFrame:
    """key, codes, within (sum of the logarithms of the words' shares of their codes) of every document,
    as a written table. The dictionaries meet the counts word by word; a segment's entries and documents
    then meet in one group, which SEGMENT bounds."""
    spark = segs.sparkSession
    known = F.broadcast(spark.createDataFrame([(w, i) for i, w in enumerate(words)], "w string, own int"))
    # As many rows as codes that are shared.
    sums = counts.join(known, "w", "left_anti").groupBy(_code("w", len(words), base).alias("code")).agg(F.sum("n").alias("total"))
    totals = np.ones(base * base)
    for r in sums.collect():
        totals[r.code] = r.total
    # Counts, not shares, travel: they are small numbers.
    times = F.when(F.col("own").isNull(), F.coalesce("n", F.lit(1)))
    entries = _entries(segs).drop("n").join(counts, "w", "left").join(known, "w", "left")
    entries = entries.select("seg", "pos", F.coalesce("own", _code("w", len(words), base)).alias("code"), times.alias("n"))

    def meet(documents: pa.Table, entries: pa.Table) -> pa.Table:
        pos = entries["pos"].to_numpy()
        own, shares = np.zeros(len(pos), np.int32), np.zeros(len(pos))
        own[pos] = entries["code"].to_numpy()
        shares[pos] = np.nan_to_num(np.log(entries["n"].to_numpy() / totals[entries["code"].to_numpy()]))  # null: a code of its own
        numbers, offsets = unpacked(documents["ids"].combine_chunks())
        n = documents.num_rows
        rows = np.repeat(np.arange(n), np.diff(offsets))
        within = np.bincount(rows, shares[numbers], n) if n else np.zeros(0)
        return pa.table([documents["key"], packed(own[numbers], offsets), pa.array(within, pa.float64())], names=["key", "codes", "within"])

    kind = segs.schema["key"].dataType.simpleString()
    documents = segs.where("ids is not null").select(F.col("seg").alias("of"), "key", "ids")
    return table(documents.groupBy("of").cogroup(entries.groupBy("seg")).applyInArrow(meet, f"key {kind}, codes binary, within double"), "lm-codes", "zstd")


def _held(codes: pa.Array, pad: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(lengths, line, at) of some documents at a time: _HELD words, or one document."""
    (values, offsets), a = unpacked(codes), 0
    while a < len(codes):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + _HELD, "right")) - 1)
        yield np.diff(offsets[a : b + 1]), *laid_out(values[offsets[a] : offsets[b]], np.diff(offsets[a : b + 1]), pad)
        a = b


def trained(codes: DataFrame, net: dict[str, np.ndarray], rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """The network after `rounds` over the codes of all documents."""
    pad = len(net["embedding"]) - 1
    for _ in range(rounds):
        begin = net

        def run(batches: Iterator[pa.RecordBatch], begin=begin) -> Iterator[pa.RecordBatch]:
            own = {k: v.copy() for k, v in begin.items()}
            past = {k: np.full_like(v, 1e-4) for k, v in own.items()}
            seen = 0
            for batch in batches:
                for _, line, at in _held(batch.column(0), pad):
                    for step in steps(line, at):
                        train(own, past, *step)
                    seen += len(at)
            change = (flat(own) - flat(begin)).astype(float)
            for block in range(0, len(change) if seen else 0, 1024):
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([seen]), pa.array([change[block : block + 1024]], pa.list_(pa.float64()))],
                                                 names=["block", "seen", "change"])

        changes = codes.select("codes").mapInArrow(run, "block long, seen long, change array<double>")
        rows = changes.select("seen", F.col("block"), F.posexplode("change").alias("at", "x"))
        mean = rows.groupBy((F.col("block") + F.col("at")).alias("i")).agg((F.sum(F.col("seen") * F.col("x")) / F.sum("seen")).alias("x"))
        values = flat(net).astype(float)
        for r in mean.toLocalIterator():  # as many rows as the network has weights
            values[r.i] += round(r.x, 7)
        net = shaped(values, net)
    return net


def _fitted(segs: DataFrame, rounds: int) -> tuple[tuple[str, ...], dict[str, np.ndarray], DataFrame, DataFrame]:
    """(known words, network, counts of all words, codes of the documents)."""
    counts = word_counts(segs)
    base = base_for(counts.count())
    counted = vocabulary(counts, base * base * 3 // 4)
    words = tuple(w for w, _ in counted[:-1])
    codes = coded(segs, words, counts, base)
    return words, trained(codes, start([n for _, n in counted[:-1]], counted[-1][1], base), rounds), counts, codes


def _scored(codes: DataFrame, net: dict[str, np.ndarray]) -> DataFrame:
    pad = len(net["embedding"]) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ns, sums = [np.zeros(0, np.int64)], [np.zeros(0)]
            for lengths, line, at in _held(batch.column(1), pad):
                value = np.concatenate([log_probabilities(net, *step) for step in steps(line, at)] or [np.empty(0)])
                ns.append(lengths)
                sums.append(np.bincount(np.repeat(np.arange(len(lengths)), lengths), value, len(lengths)))
            n, total = np.concatenate(ns), np.concatenate(sums) + batch.column(2).to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(total, pa.float64())], names=["doc_id", "n_words", "total"])

    kind = codes.schema["key"].dataType.simpleString()
    rows = codes.select("key", "codes", "within").mapInArrow(run, f"doc_id {kind}, n_words long, total double")
    return rows.select("doc_id", "n_words", F.round("total", 4).alias("log_probability"),
                       F.when(F.col("n_words") > 0, F.round(F.col("total") / F.col("n_words"), 6)).alias("mean_log_probability"))


def fit(docs: DataFrame, text: str = "text", rounds: int = ROUNDS, key: str = "doc_id") -> tuple[tuple[str, ...], dict[str, np.ndarray], DataFrame]:
    """(known words, network, counts of all words) of a corpus."""
    return _fitted(segments(docs, text, key), rounds)[:3]


def scores(docs: DataFrame, words: tuple[str, ...], net: dict, counts: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_words, log_probability (sum), mean_log_probability of every row."""
    return _scored(coded(segments(docs, text, key), words, counts, net["high"].shape[1]), net)


def scored_by_own(docs: DataFrame, text: str = "text", key: str = "doc_id", rounds: int = ROUNDS) -> DataFrame:
    """`scores` of a corpus by the network that is trained on it; the texts are cut once."""
    _, net, _, codes = _fitted(segments(docs, text, key), rounds)
    return _scored(codes, net)


def op4_lm_score(spark, sf_dir):
    return scored_by_own(spark.read.parquet(f"{sf_dir}/documents.parquet"))
