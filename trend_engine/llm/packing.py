"""Cost-balanced packing of tokenised documents into sequences of fixed length.

A document's attention cost is estimated as ``LINEAR`` n + ``QUADRATIC`` n^2 for n tokens. Within
groups of about ``GROUP`` tokens of one partition the documents go, longest first, to the sequence of
lowest cost among those with room for all of it; without such a one a document is cut and fills the
room of the cheapest sequences in turn. Longer documents are first cut into whole sequences. What
is left of a group at the end (less than one sequence) goes into sequences whose lengths are powers
of two, so nothing is padded.

One pass, no shuffle: groups never leave their partition. A lost task repeats the same groups, since
scan partitions and the order within them are fixed; sequence ids carry the partition's number.

Tokens: a byte-level BPE never joins letters across the start of a blank-led word, so words are
looked up in a table that the tokenizer itself filled; it sees every distinct word once. Texts are cut
and their words' ids put together column-wise; Python handles the distinct words of a portion only.

Cases: null and empty texts are the end token alone; repeated rows are packed each; a text of any
length is cut as needed; a null doc_id keeps null; no rows give no pieces; of extra columns nothing
is read.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trend_engine.llm._text import held, portions

#: Tokens of a sequence, tokens of a group, end of a document.
LENGTH, GROUP, END = 1024, 1 << 20, 0
#: Bytes of text that are tokenised at once.
PORTION = 1 << 23
LINEAR, QUADRATIC = 1.0, 1.0 / 1024
#: A word with or without one blank before it, nothing else.
_PIECE = re.compile(r" ?\S+\Z")
#: Letters and the marks after them are tokens of their own.
_ENDING = re.compile(r"( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-/:-@\[-^`{-~]+)\Z")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the public tokenizer file is (a parameter of `pack`; never copied)."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Words(dict):
    """Blank-led words -> their ids as bytes (little-endian 32 bit); fills itself, a full table is emptied."""

    def __init__(self, path: str, most: int = 400_000):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model, self.most = Tokenizer.from_file(path), most
        self.model.encode_special_tokens = True
        self.mark = self.encode(["\n"])[0]

    def encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """As `encode`, for pieces without a line end: many in one text, a line each."""
        out: list[bytes] = []
        for a in range(0, len(words), 2000):
            ids = np.frombuffer(self.encode(["\n".join(words[a : a + 2000]) + "\n"])[0], "<u4")
            ends = 4 * np.flatnonzero(ids == np.frombuffer(self.mark, "<u4")[0])
            raw = ids.tobytes()
            out += [raw[p:q] for p, q in zip([0, *(ends[:-1] + 4).tolist()], ends.tolist(), strict=True)]
        return out

    def learn(self, words: list[str]) -> None:
        """Fill in `words`; one that isn't a piece gets None."""
        if len(self) > self.most:
            self.clear()
        new = [w for w in words if w not in self]
        split = [m.groups() if (m := _ENDING.match(w)) else (w,) for w in new if _PIECE.match(w)]
        parts = list({p for s in split for p in s if p not in self})
        self.update(zip(parts, self.encode_words(parts), strict=True))
        self.update((s[0] + s[1], self[s[0]] + self[s[1]]) for s in split if len(s) == 2)
        self.update((w, None) for w in new if w not in self)
        self["\n"] = self.mark

    def ids(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text of a string column (null: none). Texts whose blanks don't stand alone
        are encoded directly."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        pieces, first, direct = _pieces(texts)
        coded = pieces.dictionary_encode()
        names = coded.dictionary.cast(pa.string()).to_pylist()
        self.learn(names)
        known = [self[w] for w in names]
        missing = np.array([k is None for k in known], bool)
        which = coded.indices.to_numpy()
        row = np.repeat(np.arange(len(texts)), np.diff(first))
        direct[row[missing[which]]] = True
        # All ids one after another; a text's are those of its pieces.
        joined = pa.array([k or b"" for k in known], pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(joined.buffers()[1], np.int64)[: len(which) + 1]
        data = joined.buffers()[2].to_pybytes() if len(which) else b""
        bounds = ends[first].tolist()
        rest = iter(self.encode(texts.filter(pa.array(direct)).to_pylist()))
        return [next(rest) if d else data[a:b] for d, a, b in zip(direct.tolist(), bounds, bounds[1:], strict=False)]


def _pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Pieces that are tokenised alone as they are in the text: words with the blank before them, single
    line ends, and first words of lines. Returns them, the number of pieces before each text and at the
    end, and whether a text must be encoded directly (a zero byte, line ends that touch)."""
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    line = raw == 0x0A
    start = (raw == 0x20) | line
    start[1:] |= line[:-1]
    start[offsets[:-1][offsets[:-1] < len(raw)]] = True
    at = np.flatnonzero(start)
    bounds = np.append(at, len(raw)).astype(np.int32)
    pieces = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(raw))])
    odd = raw == 0
    odd[1:] |= line[1:] & line[:-1]
    direct = np.zeros(n, bool)
    direct[np.searchsorted(offsets, np.flatnonzero(odd), "right") - 1] = True
    return pieces, np.searchsorted(at, offsets), direct


def _words_of(path: str) -> Words:
    return held("packing", path, lambda: Words(path))


def assign(lengths: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(document, start, length, sequence, offset) of all pieces of documents of these lengths."""
    whole = lengths // length
    doc = np.repeat(np.arange(len(lengths)), whole)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(whole) - whole, whole)
    out = [(doc, nth * length, np.full(len(doc), length), np.arange(len(doc)), np.zeros(len(doc), int))]
    rest, at = lengths - whole * length, whole * length
    total, base = int(rest.sum()), len(doc)
    open_ = total // length
    # The sequences that stay are the full ones and, for what is left, powers of two.
    room = np.array([length] * open_ + [1 << b for b in range(length.bit_length() - 1, -1, -1) if total % length >> b & 1], int)
    cost, used = np.zeros(len(room)), np.zeros(len(room), int)
    pieces = []
    for d in np.argsort(-rest, kind="stable"):
        n, start = int(rest[d]), int(at[d])
        while n:
            fits = np.flatnonzero(room >= n)
            open_now = fits if len(fits) else np.flatnonzero(room)
            s = open_now[np.argmin(cost[open_now])] if len(fits) else open_now[np.argmin(cost[open_now] - 1e-9 * room[open_now])]
            k = min(n, int(room[s]))
            pieces.append((d, start, k, base + s, used[s]))
            room[s] -= k
            used[s] += k
            cost[s] += LINEAR * k + QUADRATIC * k * k
            n, start = n - k, start + k
    if pieces:
        out.append(tuple(np.array(c) for c in zip(*pieces, strict=True)))
    return tuple(np.concatenate(c).astype(np.int64) for c in zip(*out, strict=True))


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, group: int = GROUP, end: int = END,
         text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian 32 bit), doc_tokens,
    sequence_id, offset."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words_of(path)
        first, last = TaskContext.get().partitionId() << 40, np.array([end], "<u4").tobytes()
        held_keys, held_ids, held, used = [], [], 0, 0
        for part in portions(batches, 1, PORTION):
            for k, i in zip(part.column(0).to_pylist(), words.ids(part.column(1)), strict=True):
                held_keys.append(k)
                held_ids.append(i + last)
                held += len(i) // 4 + 1
                if held >= group:
                    rows, n = packed(held_keys, held_ids, first + used)
                    yield rows
                    held_keys, held_ids, held, used = [], [], 0, used + n
        if held_keys:
            yield packed(held_keys, held_ids, first + used)[0]

    def packed(keys, ids, base):
        lengths = np.array([len(i) // 4 for i in ids])
        doc, start, size, seq, offset = assign(lengths, length)
        out = [ids[d][4 * s : 4 * (s + n)] for d, s, n in zip(doc.tolist(), start.tolist(), size.tolist(), strict=True)]
        columns = [pa.array(keys, kind_).take(pa.array(doc)), pa.array(start), pa.array(size), pa.array(out, pa.binary()),
                   pa.array(lengths[doc]), pa.array(seq + base), pa.array(offset)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]), int(seq.max()) + 1

    kind = dict(docs.dtypes)[key]
    kind_ = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    return docs.select(key, F.col(text).cast("string")).mapInArrow(
        run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def op3_packing(spark, sf_dir):
    pieces = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
