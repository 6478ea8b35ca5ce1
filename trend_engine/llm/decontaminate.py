"""Benchmark decontamination by a distributed positional inverted index.

1. `build_index` cuts the documents into segments of bounded text size and inverts each: for every
   term of the segment the sorted list of its word positions. A position counts words over the whole
   segment, with room between documents, so that a list needs no document numbers. One row per
   segment is written to the shared folder; lists are delta-coded bytes. Nothing is shuffled.
2. Searches deal the queries out in blocks of bounded size. A block is sent to the tasks that read
   the index (never the whole query table at once), and every segment answers it from its own lists:
   the list of the query's rarest term there gives the candidates, each shifted by the term's offset
   in the query, and the other terms' lists, shifted by their offsets, are intersected with them.
3. `phrase_matches` returns the exact occurrences, `proximity_matches` the documents in which all
   terms of a query stand within a span of words. `contaminated` marks the words of documents that
   lie in an occurrence of a window of ten benchmark words.

Consecutive windows of an item mostly share their rarest term; its candidates are then taken once
and the equal words on both sides are followed, nine at most, instead of window by window.

Cases: null or wordless documents have no words and no hits; rows that repeat a doc_id are told
apart by their place in the index; null and wordless items give no window; an item_id that stands
on several rows counts once, a null item_id marks words but is no item; empty tables give empty
results (an empty benchmark gives documents without hits); only the id and text columns are read,
so others may have any names. A text of any length is one document; an item of any length is
cut into overlapping parts.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trend_engine.llm._common import numbered, table
from trend_engine.llm._text import classes, cut, portions

#: Words of a window.
WINDOW = 10
#: Bytes of text in a segment (one longer text makes a segment of its own).
SEGMENT = 1 << 24
#: Words in one part of a query text, parts in a block (so a block has 2 million words at most).
PART, PARTS = 2_000, 1_000
#: Candidates that are compared at once.
CANDIDATES = 1 << 21
#: Words are made of ASCII letters and digits and of everything beyond ASCII.
KINDS = classes(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]).translate(None, bytes(range(0x41, 0x5B))))

INDEX = "segment long, docs array<{id}>, n_words array<long>, terms binary, ends binary, lists binary"


def _squeeze(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(x.tobytes())


def _spread(b: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


class Segment:
    """The lists of one segment: `at(term)` are the sorted positions of a term."""

    def __init__(self, terms: pa.Array, ends: np.ndarray, positions: np.ndarray, n_words: np.ndarray, gap: int):
        self.terms, self.ends, self.positions = terms, ends, positions
        self.starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        self.base = np.concatenate([[0], np.cumsum(n_words + gap)]).astype(np.int64)
        self.n_words, self.room = n_words, int(self.base[-1]) + 1

    def term(self, words: pa.Array) -> np.ndarray:
        """Numbers of the words among the segment's terms, -1 where a word doesn't occur."""
        found = pc.index_in(words, value_set=self.terms)
        return found.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)

    def count(self, term: np.ndarray) -> np.ndarray:
        return np.where(term < 0, 0, self.ends[term] - self.starts[term])

    def gather(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of several terms one after another, and which of them each entry is of."""
        n = self.count(term)
        which = np.repeat(np.arange(len(term)), n)
        first = np.cumsum(n) - n
        return self.positions[np.arange(len(which)) - first[which] + self.starts[term][which]], which

    def has(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Whether each position is in the list of its term."""
        if not len(self.keys):
            return np.zeros(len(term), bool)
        key = term * self.room + position
        k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return (term >= 0) & (position >= 0) & (position < self.room) & (self.keys[k] == key)

    @functools.cached_property
    def keys(self) -> np.ndarray:
        """The lists as one sorted array: number of the term, then position."""
        return np.repeat(np.arange(len(self.ends)), self.ends - self.starts) * self.room + self.positions

    def document(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.base, position, "right") - 1


def invert(text: pa.Array, gap: int) -> Segment:
    """The segment of a column of texts."""
    code, words, row, _ = cut(text, KINDS)
    n_words = np.bincount(row, minlength=len(text)).astype(np.int64)
    base = np.concatenate([[0], np.cumsum(n_words + gap)]).astype(np.int64)
    within = np.arange(len(row)) - (np.cumsum(n_words) - n_words)[row]
    order = np.argsort(code, kind="stable")
    ends = np.cumsum(np.bincount(code, minlength=len(words))).astype(np.int64)
    return Segment(words, ends, (base[row] + within)[order], n_words, gap)


def build_index(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = SEGMENT) -> DataFrame:
    """The written index: one row per segment."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, n = TaskContext.get().partitionId() << 32, 0
        held, used = [], 0

        def segment(parts):
            both = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            s = invert(both.column(1), WINDOW)
            terms = pa.RecordBatch.from_arrays([s.terms], ["t"])
            with pa.BufferOutputStream() as out:
                with pa.ipc.new_stream(out, terms.schema) as w:
                    w.write_batch(terms)
                packed = zstandard.ZstdCompressor(level=1).compress(out.getvalue().to_pybytes())
            steps = np.diff(s.positions, prepend=0)
            ints = np.int32 if np.abs(steps).max(initial=0) < 1 << 31 else np.int64
            row = [pa.array([first + n]), pa.array([both.column(0).to_pylist()], pa.list_(both.schema.types[0])),
                   pa.array([s.n_words]), pa.array([packed], pa.binary()), pa.array([_squeeze(s.ends)], pa.binary()),
                   pa.array([ints().itemsize.to_bytes(1, "little") + _squeeze(steps.astype(ints))], pa.binary())]
            return pa.RecordBatch.from_arrays(row, ["segment", "docs", "n_words", "terms", "ends", "lists"])

        for part in portions(batches, 1, size):
            if held and used + part.column(1).nbytes > size:
                yield segment(held)
                held, used, n = [], 0, n + 1
            held.append(part)
            used += part.column(1).nbytes
        if held:
            yield segment(held)

    plain = docs.select(key, F.col(text).cast("string").alias("text"))
    return table(plain.mapInArrow(run, INDEX.format(id=kind)), "index")


def _open(batch: pa.RecordBatch) -> Iterator[tuple[int, Segment]]:
    for i in range(batch.num_rows):
        row = {n: batch.column(n)[i] for n in ("segment", "n_words", "terms", "ends", "lists")}
        terms = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(row["terms"].as_py())).read_all()
        lists = row["lists"].as_py()
        steps = _spread(lists[1:], "<i4" if lists[0] == 4 else "<i8")
        yield row["segment"].as_py(), Segment(terms.column(0).combine_chunks(), _spread(row["ends"].as_py(), "<i8"),
                                              np.cumsum(steps, dtype=np.int64),
                                              row["n_words"].values.to_numpy(), WINDOW)


def _blocks(queries: DataFrame, text: str, key: str) -> Iterator[list]:
    """The query texts in blocks of (id, words): parts of bounded size, `PARTS` to a block.

    The parts of a longer text overlap by a window less one word, so no window is lost."""
    def run(batches):
        for part in portions(batches, 1, 1 << 24):
            code, words, row, _ = cut(part.column(1), KINDS)
            bounds = np.searchsorted(row, np.arange(part.num_rows + 1))
            ids, out = [], []
            for i, k in enumerate(part.column(0).to_pylist()):
                a, b = int(bounds[i]), int(bounds[i + 1])
                for s in range(a, max(b - WINDOW + 1, a + (b > a)), PART - WINDOW + 1):
                    ids.append(k)
                    out.append(words.take(pa.array(code[s : min(s + PART, b)])).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(out, pa.list_(pa.binary()))], ["id", "words"])

    plain = queries.select(F.col(key).cast("string").alias("id"), F.col(text).cast("string").alias("text"))
    parts = plain.mapInArrow(run, "id string, words array<binary>")
    at = numbered(parts, [F.xxhash64("id", "words")], "place", "query-parts")
    for b in range(-(-at.count() // PARTS)):
        yield [(r.id, r.words) for r in at.where(F.expr(f"place div {PARTS} = {b}")).select("id", "words").toLocalIterator()]


def _flat(block: list) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    words = pa.array([bytes(w) for _, ws in block for w in ws], pa.binary()).dictionary_encode()
    sizes = np.array([len(ws) for _, ws in block], np.int64)
    return words.dictionary, words.indices.to_numpy().astype(np.int64), np.concatenate([[0], np.cumsum(sizes)])


def windows_of(bounds: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, part) of the windows of parts that lie between `bounds`."""
    sizes = np.diff(bounds)
    n = np.where(sizes == 0, 0, np.maximum(sizes - window + 1, 1))
    part = np.repeat(np.arange(len(sizes)), n)
    start = bounds[:-1][part] + np.arange(len(part)) - (np.cumsum(n) - n)[part]
    return start, np.minimum(sizes[part], window), part


def phrases_in(seg: Segment, term: np.ndarray, bounds: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """All occurrences of the windows in a segment: (window number, position of its first word).

    `term` has the segment's number of every query word, `bounds` the ends of the parts."""
    start, length, _ = windows_of(bounds, window)
    if not len(start) or not len(seg.positions):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    df = seg.count(term)
    # Rarest word of each window, as a place in the query texts; a shared place is looked up once.
    grid = start[:, None] + np.minimum(np.arange(window), length[:, None] - 1)
    low = df[grid]
    live = np.flatnonzero(low.min(1) > 0)
    anchor = grid[live, low[live].argmin(1)]
    places, group = np.unique(anchor, return_inverse=True)
    order = np.argsort(group, kind="stable")
    heads = np.searchsorted(group[order], np.arange(len(places) + 1))
    part_lo = bounds[np.searchsorted(bounds, places, "right") - 1]
    part_hi = bounds[np.searchsorted(bounds, places, "right")]
    found = []
    for a, b in _runs(df[places], CANDIDATES):
        pos, which = seg.gather(term[places[a:b]])
        at = places[a:b][which]
        # Equal words to both sides of each candidate, as far as a window reaches.
        reach = []
        for step, stop in ((-1, part_lo[a:b][which]), (1, part_hi[a:b][which] - 1)):
            n, go = np.zeros(len(pos), np.int64), np.arange(len(pos))
            for k in range(1, window):
                go = go[(at[go] + step * k >= stop[go]) if step < 0 else (at[go] + k <= stop[go])]
                go = go[seg.has(term[at[go] + step * k], pos[go] + step * k)]
                n[go] = k
            reach.append(n)
        left, right = reach
        # Windows of the candidate's place that lie inside the equal run.
        n = (heads[a + 1 : b + 1] - heads[a:b])[which]
        c = np.repeat(np.arange(len(pos)), n)
        w = live[order[np.arange(len(c)) - (np.cumsum(n) - n)[c] + heads[a:b][which][c]]]
        back = at[c] - start[w]
        ok = (back <= left[c]) & (length[w] - 1 - back <= right[c])
        found.append((w[ok], pos[c[ok]] - back[ok]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2


def _runs(size: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of entries whose sizes sum to about `limit` (a larger entry stands alone)."""
    ends, a = np.cumsum(size), 0
    while a < len(size):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + limit, "right")))
        yield a, b
        a = b


def near_in(seg: Segment, term: np.ndarray, bounds: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, first position) of the shortest stretches of at most `span` words that begin with a term of
    the query and hold all its different terms."""
    found = []
    for q in range(len(bounds) - 1):
        t = np.unique(term[bounds[q] : bounds[q + 1]])
        if not len(t) or t[0] < 0:
            continue
        lists = [seg.positions[seg.starts[x] : seg.ends[x]] for x in t[np.argsort(seg.count(t), kind="stable")]]
        rare = lists[0]
        # Beginnings lie in reach of the rarest term; the others must follow within the span.
        first = np.unique(np.concatenate([x[_within(x, rare, span)] for x in lists]))
        for x in lists:
            k = np.searchsorted(x, first)
            first = first[(k < len(x)) & (x[np.minimum(k, len(x) - 1)] < first + span)]
        doc = seg.document(first)
        last = np.max([x[np.searchsorted(x, first)] for x in lists], axis=0) if len(first) else first
        first = first[doc == seg.document(last)]
        found.append((np.full(len(first), q), first))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2


def _within(x: np.ndarray, rare: np.ndarray, span: int) -> np.ndarray:
    k = np.searchsorted(rare, x)
    return (k < len(rare)) & (rare[np.minimum(k, len(rare) - 1)] < x + span)


def _search(index: DataFrame, queries: DataFrame, text: str, key: str, schema: str, answer) -> DataFrame:
    """`answer(segment, term, bounds, ids)` of every segment and block of queries, as rows with segment and doc."""
    spark = index.sparkSession
    out = spark.createDataFrame([], "segment long, doc int, " + schema)
    names = out.columns
    arrow = [pa.int64(), pa.int32()]
    for block in _blocks(queries, text, key):
        words, code, bounds = _flat(block)
        sent = spark.sparkContext.broadcast((words, code, bounds, [i for i, _ in block]))

        def run(batches, sent=sent):
            words, code, bounds, ids = sent.value
            for batch in batches:
                for segment, seg in _open(batch):
                    doc, *columns = answer(seg, seg.term(words)[code], bounds, ids)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(doc), segment), arrow[0]), pa.array(doc, arrow[1]), *columns], names)

        hits = index.select("segment", "n_words", "terms", "ends", "lists").mapInArrow(run, out.schema)
        out = out.unionByName(hits)
    return out


def _documents(index: DataFrame) -> DataFrame:
    """(segment, doc, doc_id, n_words) of every document row."""
    each = index.select("segment", F.posexplode(F.arrays_zip("docs", "n_words")).alias("doc", "d"))
    return each.select("segment", "doc", F.col("d.docs").alias("doc_id"), F.col("d.n_words").alias("n_words"))


def phrase_matches(index: DataFrame, queries: DataFrame, text: str = "text", key: str = "item_id",
                   window: int = WINDOW) -> DataFrame:
    """Exact occurrences: doc_id, item_id (as text), start and length in words of every stretch of a
    document that is covered by occurrences of windows of that item."""
    def answer(seg, term, bounds, ids):
        w, pos = phrases_in(seg, term, bounds, window)
        start, length, part = windows_of(bounds, window)
        n, kinds = len(w), {}
        item = np.array([kinds.setdefault(i, len(kinds)) for i in ids], np.int64)[part[w]]
        order = np.lexsort((pos, item))
        item, pos, size = item[order], pos[order], length[w][order]
        # Runs of occurrences that touch or overlap; windows of one item have one length.
        new = np.ones(n, bool)
        new[1:] = (item[1:] != item[:-1]) | (pos[1:] > pos[:-1] + size[:-1])
        at = np.flatnonzero(new)
        end = (pos + size)[np.append(at[1:], n) - 1] if n else pos
        names = pa.array(list(kinds), pa.string())
        doc = seg.document(pos[at])
        return (doc, names.take(pa.array(item[at])), pa.array(pos[at] - seg.base[doc]), pa.array(end - pos[at]))

    if window > WINDOW:
        raise ValueError(f"the index leaves room for windows of {WINDOW} words")
    hits = _search(index, queries, text, key, "item_id string, start long, length long", answer)
    return hits.join(_documents(index), ["segment", "doc"]).select("doc_id", "item_id", "start", "length", "segment", "doc")


def proximity_matches(index: DataFrame, queries: DataFrame, span: int, text: str = "text", key: str = "item_id") -> DataFrame:
    """Documents in which all terms of a query (up to `PART` words of it) stand, in any order, within
    `span` words: doc_id, item_id (as text) and the number of places where such a stretch begins."""
    def answer(seg, term, bounds, ids):
        q, pos = near_in(seg, term, bounds, span)
        doc = seg.document(pos)
        pair, n = np.unique(np.stack([q, doc]), axis=1, return_counts=True)
        return (pair[1], pa.array(ids, pa.string()).take(pa.array(pair[0])), pa.array(n.astype(np.int64)))

    hits = _search(index, queries, text, key, "item_id string, places long", answer)
    return hits.join(_documents(index), ["segment", "doc"]).select("doc_id", "item_id", "places")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    index = build_index(docs)
    hits = phrase_matches(index, benchmark)
    # Words of a document that lie in any stretch: stretches in order, each adds what lies beyond the last end.
    found = hits.groupBy("segment", "doc").agg(
        F.array_sort(F.collect_set(F.struct("start", "length"))).alias("stretches"),
        F.array_sort(F.collect_set("item_id")).alias("items"))
    covered = F.aggregate(
        "stretches", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0).cast("long"), x["start"] + x["length"] - F.greatest(s["end"], x["start"]))).alias("n"),
            F.greatest(s["end"], x["start"] + x["length"]).alias("end")), lambda s: s["n"])
    found = found.select("segment", "doc", covered.alias("n_hit"), "items")
    rows = _documents(index).join(found, ["segment", "doc"], "left")
    n_hit, items = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("items", F.array().cast("array<string>"))
    return rows.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                       F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                        spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
