"""Vectorised hashes of words and word shingles of many texts at once (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15 | 1)
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))
_STEP = U(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 20)
        _powers[:] = [np.cumprod(np.concatenate([[U(1)], np.full(size - 1, b, U)])) for b in (_BASE, _INVERSE)]
    return _powers


def chunks(texts: list[bytes], limit: int = 1 << 20):
    """Index ranges of `texts` of about `limit` bytes each; a longer text stands alone."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all words of the texts in order: hash, index of the text, start in the joined buffer."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    space = _SPACE[buf]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space])))  # starts and ends in turn
    start, end = edge[::2], edge[1::2]
    power, inverse = _power_tables(len(buf) + 1)
    sums = np.concatenate([[U(0)], np.cumsum((buf.astype(U) + U(1)) * power[: len(buf)])])
    hashes = mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(U))
    stops = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.searchsorted(stops, start, side="right"), start


def shingles(hashes: np.ndarray, owner: np.ndarray, count: int, width: int) -> list[np.ndarray]:
    """Per text, its distinct shingles of `width` words as sorted 64-bit hashes.

    A text of fewer words has one shingle, the whole sequence; without words it has none.
    """
    value = np.zeros(max(0, len(hashes) - width + 1), U)
    for k in range(width):
        value = value * _STEP + hashes[k : len(hashes) - width + 1 + k]
    value = mix(value)
    first = np.searchsorted(owner, np.arange(count + 1))
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= width:
            out.append(np.unique(value[a : b - width + 1]))
        elif b > a:
            h = np.array([b - a], U)
            for k in range(a, b):
                h = h * _STEP + hashes[k : k + 1]
            out.append(mix(h))
        else:
            out.append(np.empty(0, U))
    return out
