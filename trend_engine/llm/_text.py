"""Words of many texts at once: whole Arrow columns are cut and coded with numpy, inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa

#: Classes of a byte: part of a word, between words, between pieces of words.
IN, GAP, BREAK = 0, 1, 2

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


_held: dict[tuple[str, Hashable], Any] = {}


def held(owner: str, key: Hashable, make: Callable[[], Any]) -> Any:
    """What a task of `owner` leaves to the next ones in its process. Only the last owner's and key's is held: Spark's
    Python workers go on with the tasks of other operators, which would have its memory beside their own."""
    if (owner, key) not in _held:
        _held.clear()
        pa.default_memory_pool().release_unused()
        _held[owner, key] = make()
    return _held[owner, key]


def classes(gaps: bytes, breaks: bytes = b"") -> np.ndarray:
    """The class of every byte value; bytes of multi-byte letters are parts of words."""
    out = np.full(256, IN, np.uint8)
    out[list(gaps)] = GAP
    out[list(breaks)] = BREAK
    return out


def portions(batches: Iterator[pa.RecordBatch], column: int, size: int) -> Iterator[pa.RecordBatch]:
    """Batches with texts of about `size` bytes each; a longer text stands alone."""
    for batch in batches:
        text = batch.column(column)
        offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
        a = 0
        while a < len(text):
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1)
            yield batch.slice(a, b - a)
            a = b


def cut(text: pa.Array, kinds: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """The words of a string column, A-Z lower-cased: (code, dictionary, row, piece) with one entry
    per word but for the dictionary. Pieces are numbered over all rows; null has no words."""
    n = len(text)
    offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + n + 1].astype(np.int64)
    data = text.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data and n else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if text.null_count:
        # Spark writes no bytes for nulls; others may.
        full = np.diff(offsets) * ~np.asarray(text.is_valid())
        assert not full.any(), "null with bytes"
    kind = kinds[raw]
    word = kind == IN
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(word & (edge[:-1] | ~np.concatenate([[False], word[:-1]])))
    ends = np.flatnonzero(word & (edge[1:] | ~np.concatenate([word[1:], [False]]))) + 1
    row = np.searchsorted(offsets, starts, "right") - 1
    piece = row
    if (kinds == BREAK).any():
        breaks = np.flatnonzero(kind == BREAK)
        piece = row + np.searchsorted(breaks, starts)
    letters = _LOWER[raw[word]]
    bounds = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(letters)])
    coded = words.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary, row, piece
