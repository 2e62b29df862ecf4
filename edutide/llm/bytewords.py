"""Whole-column word splitting over the UTF-8 bytes of Arrow string arrays.

Words are maximal runs of "word bytes" inside a document. As every byte of a multi-byte character is at least 0x80,
byte classes that treat 0x80-0xFF alike split exactly as the corresponding character classes do.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import wraps

import numpy as np
import pyarrow as pa

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: Word bytes of `[^\x20\x09-\x0D]+`.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: Word bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`.
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (shift, multiply, shift)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def release() -> None:
    """Give memory that is free in this Python worker back, since Spark keeps the worker for later stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def freed(run: Callable) -> Callable:
    """`run`, a function of batches for mapInArrow, that gives its memory back at its end."""

    @wraps(run)
    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(given)
        finally:
            release()

    return batches


def distinct(x: np.ndarray) -> np.ndarray:
    """The distinct values, sorted. A plain sort: much faster here than a hash table of them."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def counted(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, sorted, and how often each stands in x."""
    x = np.sort(x)
    at = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)
    return x[at], np.diff(np.append(at, len(x)))


_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n, 64) - 1, _BASE)]), dtype=np.uint64)
    return _powers[:n]


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after another, and each text's start (one more than there are texts). Null: empty."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    off = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def pieces(batches: Iterator[pa.RecordBatch], size: int = 1 << 20, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches of whole rows with about `size` bytes of text each (a longer text is alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = flat(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(off, off[at] + size, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


@dataclass
class Words:
    """data: lower-cased (if asked) bytes; start, end: of each word in data; first: index of each text's first word."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        n = self.end - self.start
        if not len(n):
            return np.zeros(0, np.uint64)
        begin = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(begin, n)
        value = self.data[np.repeat(self.start, n) + place].astype(np.uint64) + np.uint64(1)
        return mix(np.add.reduceat(value * powers(int(n.max()))[place], begin) + n.astype(np.uint64))

    def text(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def split(texts: pa.Array, word_bytes: np.ndarray, lower: bool = True) -> Words:
    data, off = flat(texts)
    if lower:
        data = LOWER[data]
    inside = word_bytes[data]
    before = np.zeros_like(inside)
    before[1:] = inside[:-1]
    before[off[:-1][off[:-1] < len(data)]] = False
    after = np.zeros_like(inside)
    after[:-1] = inside[1:]
    after[off[1:][off[1:] > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Words(data, start, end, np.searchsorted(start, off))


def shingles(words: Words, k: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word runs and the text of each. short: a text of 1 to k-1 words has one run, all its words."""
    h, n = words.hashes(), np.diff(words.first)
    doc = words.doc
    left = words.first[doc + 1] - np.arange(len(h))
    starts = (left >= k) | (short & (n[doc] < k) & (np.arange(len(h)) == words.first[doc]))
    at = np.flatnonzero(starts)
    padded = np.concatenate([h, np.zeros(k, np.uint64)])
    out = np.zeros(len(at), np.uint64)
    for j in range(k):
        term = padded[at + j] if j == 0 else np.where(left[at] > j, padded[at + j], np.uint64(0))
        out = mix(out + np.uint64(0x9E3779B97F4A7C15 * (j + 1) % 2**64)) ^ mix(term + out * np.uint64(0xD6E8FEB86659FD93))
    return out, doc[at]
