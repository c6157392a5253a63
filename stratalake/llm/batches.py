"""Words and their hashes for Arrow columns of text, computed for many documents at once.

A text is its UTF-8 bytes. A word is a maximal run of word bytes inside one document; every byte of a
character beyond ASCII counts as one class, so runs never end inside a character. NULL reads as the
empty text, which has no words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20


def byte_table(inside: Callable[[int], bool]) -> np.ndarray:
    """For every byte, whether it belongs to a word."""
    return np.array([inside(b) for b in range(256)])


NOT_SPACE = byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
ALPHANUMERIC = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)

_FACTOR = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_WORD = np.uint64(pow(_FACTOR, 3, 1 << 64))


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = x + np.uint64((seed * 0xD6E8FEB86659FD93 + 0x9E3779B97F4A7C15) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODES = mix(np.arange(256, dtype=np.uint64), 7)


def _powers(base: int, count: int) -> np.ndarray:
    factors = np.full(count, base % (1 << 64), dtype=np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


@dataclass
class Words:
    """Words of some documents: byte spans, 64-bit hashes and the first word of each document."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # one entry per document and a closing one

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def grams(self, size: int, seed: int = 0) -> np.ndarray:
        """A hash for each run of ``size`` words, also over document ends: see ``inside``."""
        count = max(0, len(self.hash) - size + 1)
        total = np.zeros(count, dtype=np.uint64)
        for i in range(size):
            total = total * _WORD + self.hash[i:i + count]
        return mix(total, seed + size)

    def inside(self, size: int) -> np.ndarray:
        """For each run of ``size`` words, whether it lies in one document."""
        count = max(0, len(self.hash) - size + 1)
        inside = np.ones(count + size, dtype=bool)
        for back in range(1, size):
            at = self.first[1:-1] - back
            inside[at[(at >= 0) & (at < count)]] = False
        return inside[:count]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each text starts, with a closing entry."""
    if pa.types.is_large_string(texts.type):
        width = np.int64
    else:
        texts, width = texts.cast(pa.string()), np.int32
    texts = pc.fill_null(texts, "")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=width)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    if data is None or not len(texts):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]], at - at[0]


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = NOT_SPACE, lower: bool = True) -> Words:
    """The words of the documents whose bytes are ``data``."""
    if lower:
        data = LOWER[data]
    is_word = np.concatenate(([False], inside[data], [False]))
    breaks = np.zeros(len(data) + 1, dtype=bool)
    breaks[offsets] = True
    start = np.flatnonzero(is_word[1:] & (~is_word[:-1] | breaks))
    end = np.flatnonzero(is_word[:-1] & (~is_word[1:] | breaks))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODES[data] * _powers(_FACTOR, max(1, len(data)))[:len(data)], out=sums[1:])
    back = _powers(pow(_FACTOR, -1, 1 << 64), max(1, len(data)))
    hashes = mix((sums[end] - sums[start]) * back[start]) if len(start) else np.zeros(0, dtype=np.uint64)
    return Words(start, end, hashes, np.searchsorted(start, offsets))


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``limit`` bytes of text each, so that working memory does not depend
    on the batch size; a longer text is a slice of its own."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.cumsum(sizes) // limit
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1, [batch.num_rows]))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield batch.slice(a, b - a)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, … of each range, one range after the other."""
    total = int(counts.sum())
    shift = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return np.arange(total, dtype=np.int64) + shift
