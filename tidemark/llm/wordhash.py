"""Words of whole texts as numpy arrays: positions, 64-bit hashes and hashes of word runs.

A batch of texts is one UTF-8 buffer. Words are maximal runs of bytes other than white space (0x20, 0x09-0x0D), so no
character is ever cut. Hashes are polynomials over the bytes of a word modulo 2^64, mixed afterwards; they are the same
in every task and at every run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C55 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_CODE = np.random.default_rng(20240801).integers(1, 1 << 63, 256, dtype=np.uint64)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS: dict[int, np.ndarray] = {}
CHUNK_BYTES = 1 << 19


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^n modulo 2^64; kept per process, as long as the longest chunk so far."""
    have = _POWERS.get(base)
    if have is None or len(have) <= n:
        factors = np.full(max(n, CHUNK_BYTES) + 1, base, np.uint64)
        factors[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(factors)
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finalizer of splitmix64)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def buffer_of(texts: pd.Series | pa.Array | list) -> tuple[np.ndarray, np.ndarray]:
    """One byte buffer of the texts (null: empty) and where each begins in it, with the total at the end."""
    array = pa.array(texts, pa.large_string(), from_pandas=True).fill_null("")
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset: array.offset + len(array) + 1]
    if not len(array) or array.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    data = np.frombuffer(array.buffers()[2], np.uint8)[offsets[0]: offsets[-1]]
    return data, offsets - offsets[0]


@dataclass
class Words:
    """Words of a few texts: byte range and hash of each word, and the first word of each text (total at the end)."""

    data: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    text_starts: np.ndarray

    def runs(self, length: int) -> np.ndarray:
        """Hash of the ``length`` words from each word on; where a text ends earlier the value means nothing."""
        return run_hashes(self.hashes, length)


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Mixed polynomial hash of ``length`` consecutive values from each position; zero-padded at the end."""
    n = len(hashes)
    out = np.zeros(n, np.uint64)
    if n < length:
        return out
    power, inverse = _powers(_INVERSE, n), _powers(_BASE, n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * inverse[:n], out=total[1:])
    out[: n - length + 1] = mix((total[length:] - total[: n - length + 1]) * power[: n - length + 1] + np.uint64(length))
    return out


def words_of(data: np.ndarray, text_starts: np.ndarray, lower: bool = False, is_space: np.ndarray = _IS_SPACE) -> Words:
    """Split a buffer of whole texts into words."""
    space = is_space[data]
    n = len(data)
    edge = np.ones(n + 1, bool)
    if n:
        edge[1:n] = space[1:] != space[:-1]
    cuts = text_starts[1:-1]
    edge[cuts] = True
    at = np.flatnonzero(edge[:n]) if n else np.zeros(0, np.int64)
    begins = at[~space[at]]
    following = np.append(at[1:], n)
    ends = following[~space[at]]
    codes = _BYTE_CODE[_LOWER[data] if lower else data]
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(codes * _powers(_BASE, n)[:n], out=total[1:])
    hashes = mix((total[ends] - total[begins]) * _powers(_INVERSE, n)[begins] + (ends - begins).astype(np.uint64))
    return Words(data, begins, ends, hashes, np.searchsorted(begins, text_starts), text_starts)


def chunks(data: np.ndarray, starts: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts whose bytes stay within ``limit``; a longer text makes a range of its own."""
    begin, n = 0, len(starts) - 1
    while begin < n:
        end = int(np.searchsorted(starts, starts[begin] + limit, side="right")) - 1
        end = min(max(end, begin + 1), n)
        yield begin, end
        begin = end


def each_words(texts: pd.Series, lower: bool = False, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """The words of a batch of texts, a bounded number of bytes at a time: (first text, end text, words)."""
    data, starts = buffer_of(texts)
    for begin, end in chunks(data, starts, limit):
        part = data[starts[begin]: starts[end]]
        yield begin, end, words_of(part, starts[begin: end + 1] - starts[begin], lower)


def shingles_of(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``k``-word shingles and where each text's begin (total at the end).

    A text of fewer words has its whole sequence as its one shingle; a text without words has none.
    """
    count = np.diff(words.first)
    number = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    where = np.zeros(len(number) + 1, np.int64)
    np.cumsum(number, out=where[1:])
    index = np.arange(where[-1]) + np.repeat(words.first[:-1] - where[:-1], number)
    out = words.runs(k)[index] if len(index) else np.zeros(0, np.uint64)
    for i in np.flatnonzero((count > 0) & (count < k)):
        own = words.hashes[words.first[i]: words.first[i + 1]]
        out[where[i]] = run_hashes(own, len(own))[0]
    return out, where
