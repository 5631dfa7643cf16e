"""Words of whole texts as 64-bit hashes, straight from the bytes of an Arrow column.

A word is a longest run of digits, letters and characters beyond ASCII; only A-Z are lower-cased. Every byte of a character
beyond ASCII is one of a word, so words are found byte by byte. A word's hash is a polynomial of its bytes, mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Byte -> its lower-case form inside a word, 0 between words.
BYTES = np.zeros(256, np.uint8)
for _b in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    BYTES[_b] = _b
for _b in range(0x41, 0x5B):
    BYTES[_b] = _b + 32
BASE = 0x9E3779B97F4A7C15 | 1
SPAN = 1 << 20


@lru_cache(4)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse, modulo 2**64."""
    with np.errstate(over="ignore"):
        both = []
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
    return both[0], both[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes_at(low: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hashes of the words that begin at ``starts``; bytes between words are 0 and add nothing."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        first = starts[at]
        to = max(at + 1, int(np.searchsorted(starts, first + SPAN)))
        end = starts[to] if to < len(starts) else len(low)
        size = int(end - first)
        up, down = powers(SPAN) if size <= SPAN else powers(1 << size.bit_length())
        own = starts[at:to] - first
        out[at:to] = np.add.reduceat(low[first:end] * up[:size], own) * down[own]
        at = to
    return mixed(out)


def word_starts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lower-case bytes of all texts with 0 between words, where words begin, number of words per text). A null text has none."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1 + texts.offset)[texts.offset :]
    n = int(bounds[-1] - bounds[0])
    if n == 0:
        return np.empty(0, np.uint8), np.empty(0, np.int64), np.zeros(len(texts), np.int64)
    low = BYTES[np.frombuffer(texts.buffers()[2], np.uint8, n, int(bounds[0]))]
    bounds = bounds - bounds[0]
    begins = low != 0
    begins[1:] &= low[:-1] == 0
    heads = bounds[:-1][np.diff(bounds) > 0]
    begins[heads] = low[heads] != 0  # a text does not go on in the next
    starts = np.flatnonzero(begins)
    return low, starts, np.diff(np.searchsorted(starts, bounds))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in a row, number of words per text)."""
    low, starts, counts = word_starts(texts)
    return (hashes_at(low, starts) if len(starts) else np.empty(0, np.uint64)), counts


def text_slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most ``limit`` bytes of text, or one row."""
    sizes = np.nan_to_num(np.array(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False), np.float64))
    lot = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(lot)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)
