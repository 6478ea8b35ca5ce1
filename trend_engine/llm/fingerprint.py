"""Document fingerprints: a homomorphic multiset hash over paragraphs.

A paragraph (line) is hashed to a wide vector and a document's fingerprint is the sum of its
paragraphs' vectors: ``EXACT`` lanes modulo 2^64 (BLAKE2b of the paragraph) decide equality,
``LANES`` lanes modulo 2^16 (signed sums over the paragraph's word pairs) keep a likeness: their
distance estimates how many word pairs two documents don't share. Sums don't depend on the order
of paragraphs, and adding or subtracting a paragraph's vector inserts or deletes it.

`with_edits` also needs each document's successor by descending doc_id. Documents are dealt into
ranges of doc_id (borders from approximate quantiles; they only balance the load); each range gets
a copy of the document that follows its last one. One shuffle of the texts, each range is read as a
sorted stream.

Cases: null and empty texts have no paragraphs (all lanes 0); equal texts have equal fingerprints,
so repeated rows are alike; rows of the same doc_id follow one another by text, a null doc_id comes
last; a single row is its own successor; no rows give no rows; extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trend_engine.llm import _hashing as H

EXACT, LANES = 8, 256
#: Code points of text that a range is to hold.
RANGE_CHARS = 24_000_000


def vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(exact lanes as uint64, likeness lanes as uint16) of each text: sums over its paragraphs."""
    exact = np.zeros((len(texts), EXACT), np.uint64)
    near = np.zeros((len(texts), LANES), np.uint16)
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    for a, b in H.chunks(raw):
        part = raw[a:b]
        paragraphs = [t.split(b"\n") if t else [] for t in part]
        digests = b"".join(hashlib.blake2b(p, digest_size=8 * EXACT).digest() for ps in paragraphs for p in ps)
        rows = np.frombuffer(digests, "<u8").reshape(-1, EXACT).astype(np.uint64)
        sums = np.concatenate([np.zeros((1, EXACT), np.uint64), np.cumsum(rows, axis=0, dtype=np.uint64)])
        ends = np.cumsum([len(ps) for ps in paragraphs])
        exact[a:b] = sums[ends] - sums[np.concatenate([[0], ends[:-1]])]
        word, owner, start = H.words(part)
        line = np.cumsum(np.frombuffer(b"\n".join(part) + b"\n", np.uint8) == 10)[start]
        before = np.concatenate([[np.uint64(0)], word[:-1]]) if len(word) else word
        first = np.concatenate([[True], line[1:] != line[:-1]]) if len(word) else np.zeros(0, bool)
        pair = H.mix(np.where(first, np.uint64(1), before) * np.uint64(0x9E3779B97F4A7C15) + word)
        at = owner * LANES + (pair % np.uint64(LANES)).astype(np.int64)
        sign = 1.0 - 2.0 * ((pair >> np.uint64(32)) & np.uint64(1)).astype(float)
        total = np.bincount(at, weights=sign, minlength=len(part) * LANES)
        near[a:b] = (total.astype(np.int64) % 65536).astype(np.uint16).reshape(len(part), LANES)
    return exact, near


def insert(exact: np.ndarray, near: np.ndarray, paragraphs: list[str], times: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of a document after `paragraphs` were added (times=-1: taken out)."""
    more = [vectors([p]) if p else _blank() for p in paragraphs]
    for e, n in more:
        exact = exact + e[0] if times > 0 else exact - e[0]
        near = near + n[0] if times > 0 else near - n[0]
    return exact, near


def _blank() -> tuple[np.ndarray, np.ndarray]:
    """An empty paragraph: "\\n" has two of them, so half of its vector is one."""
    e = np.frombuffer(hashlib.blake2b(b"", digest_size=8 * EXACT).digest(), "<u8").astype(np.uint64)
    return e[None], np.zeros((1, LANES), np.uint16)


def text_of(exact: np.ndarray, near: np.ndarray) -> list[str]:
    """Fingerprints as text (base64, little-endian)."""
    return [base64.b64encode(e.astype("<u8").tobytes() + n.astype("<u2").tobytes()).decode() for e, n in zip(exact, near, strict=True)]


def from_text(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [base64.b64decode(t) for t in texts]
    return (np.array([np.frombuffer(r[: 8 * EXACT], "<u8") for r in raw], np.uint64).reshape(-1, EXACT),
            np.array([np.frombuffer(r[8 * EXACT :], "<u2") for r in raw], np.uint16).reshape(-1, LANES))


def likeness(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """0 to 1, row by row: 1 for equal fingerprints, else the share of word pairs in common.

    From |x - y|^2 against |x|^2 + |y|^2, with lanes read as signed numbers.
    """
    a, b = x[1].astype(np.int16).astype(float), y[1].astype(np.int16).astype(float)
    d = (x[1] - y[1]).astype(np.int16).astype(float)
    norm = (a * a).sum(1) + (b * b).sum(1)
    near = np.clip(1 - (d * d).sum(1) / np.maximum(norm, 1), 0, 1)
    return np.where((x[0] == y[0]).all(1), 1.0, np.where(norm > 0, near, 0.0))


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_chars, fingerprint of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t) for t in texts], pa.int64()),
                                              pa.array(text_of(*vectors(texts)), pa.string())], names=["doc_id", "n_chars", "fingerprint"])

    return docs.select(key, F.col(text).cast("string")).mapInArrow(run, f"doc_id {dict(docs.dtypes)[key]}, n_chars long, fingerprint string")


def _ranges(docs: DataFrame) -> DataFrame:
    """_range, _ahead, doc_id, text: the rows of each range, and the row after its last one."""
    size = docs.agg(F.sum(F.length("text")).alias("chars"), F.count("doc_id").alias("ids")).first()
    parts = max(1, math.ceil((size.chars or 0) / RANGE_CHARS)) if size.ids else 1
    borders = []
    if parts > 1:
        shares = [k / parts for k in range(1, parts)]
        borders = sorted(set(docs.agg(F.percentile_approx("doc_id", shares, 100 * parts)).first()[0]))

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        at = np.searchsorted(np.array(borders, np.int64), ids.fillna(-(1 << 63)).astype("int64").to_numpy(), side="right")
        return pd.Series(at).where(ids.notna().to_numpy(), 0)

    # One row per range: its highest doc_id (null if it holds none but null).
    tops = sorted(docs.select(place("doc_id").alias("r"), "doc_id").groupBy("r").agg(F.max("doc_id").alias("top")).collect(), key=lambda x: -x.r)
    ahead: dict[int | None, list[int]] = {}
    for here, after in zip(tops, [*tops[1:], *tops[:1]], strict=True):
        ahead.setdefault(after.top, []).append(here.r)

    @F.pandas_udf("array<int>")
    def copies(ids: pd.Series) -> pd.Series:
        return pd.Series([ahead.get(None if pd.isna(i) else int(i), []) for i in ids], dtype=object)

    rows = docs.withColumn("_place", place("doc_id")).withColumn("_copies", copies("doc_id"))
    own = F.array(F.struct(F.col("_place").alias("r"), F.lit(False).alias("a")))
    more = F.transform("_copies", lambda r: F.struct(r.alias("r"), F.lit(True).alias("a")))
    rows = rows.withColumn("_to", F.explode(F.concat(own, more)))
    return rows.select(F.col("_to.r").alias("_range"), F.col("_to.a").alias("_ahead"), "doc_id", "text"), parts


def with_edits(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. The edited text ends with the beginning of the next document (by descending doc_id,
    the first follows the last) in place of its own last third."""
    rows, parts = _ranges(docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")))

    def results(ids: list, texts: list[str]) -> pa.RecordBatch:
        """Of all rows but the last, which is the successor of the one before it."""
        edited = [t[: len(t) - len(t) // 3] + after[: len(t) // 3] for t, after in zip(texts[:-1], texts[1:], strict=True)]
        print_, other = vectors(texts), vectors(edited)
        here, after = (print_[0][:-1], print_[1][:-1]), (print_[0][1:], print_[1][1:])
        columns = [pa.array(ids[:-1], pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
                   pa.array([hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited]),
                   pa.array(text_of(*here), pa.string()), pa.array(text_of(*other), pa.string()),
                   pa.array(likeness(here, other)), pa.array(likeness(here, after))]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_chars", "edited_sha256", "fingerprint",
                                                          "edited_fingerprint", "near_edited", "near_next"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done, ids, texts, size = None, False, [], [], 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in range(4))
            for r, is_ahead, i, t in zip(*columns, strict=True):
                if r != now:
                    now, done, ids, texts, size = r, False, [], [], 0
                if done:
                    continue  # further rows of the successor's doc_id
                ids.append(i)
                texts.append(t)
                size += len(t)
                if is_ahead or size > 4_000_000:
                    if len(ids) > 1:
                        yield results(ids, texts)
                    ids, texts, size, done = ids[-1:], texts[-1:], len(t), is_ahead

    order = ["_range", "_ahead", F.col("doc_id").desc_nulls_last(), "text"]
    return rows.repartition(parts, "_range").sortWithinPartitions(*order).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op10_fingerprint(spark, sf_dir):
    return with_edits(spark.read.parquet(f"{sf_dir}/documents.parquet"))
