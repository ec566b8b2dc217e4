"""Vectorised word kernels over Arrow string columns.

A word is a maximal run of bytes other than space and 0x09-0x0D.  UTF-8 never
uses those bytes inside a longer character, so words are found on raw bytes.
Every function works on whole texts; chunks only bound how many *documents* are
handled at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_SEP = np.zeros(256, bool)
_SEP[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_M = (1 << 64) - 1
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95  # odd, so invertible mod 2^64


def fmix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_BYTE = fmix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_POWERS: dict[tuple[int, int], np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get((base, 0))
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _POWERS[(base, 0)] = have
    return have[:n]


@dataclass
class Words:
    """Words of consecutive documents: byte ranges, and the first word of each document."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # per document, and one past the last

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def window_starts(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Global word index and document of each run of n words inside one document."""
        per = np.maximum(self.counts - n + 1, 0)
        doc = np.repeat(np.arange(len(per)), per)
        at = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per) + self.first[:-1][doc]
        return at, doc


def string_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and offsets of its rows; null rows are empty."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and len(col) else np.zeros(0, np.uint8)
    return raw, (off - off[0]) if len(off) else np.zeros(1, np.int64)


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `limit` bytes of text each; a longer text gets a slice of its own."""
    if not batch.num_rows:
        return
    sizes = np.diff(string_bytes(batch.column(column))[1])
    begin, total = 0, 0
    for i, s in enumerate(sizes.tolist()):
        if i > begin and total + s > limit:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += s
    yield batch.slice(begin)


def split_words(col: pa.Array) -> Words:
    data, off = string_bytes(col)
    word = ~_SEP[data]
    st, en = word.copy(), word.copy()
    st[1:] &= ~word[:-1]
    en[:-1] &= ~word[1:]
    at = off[:-1][off[:-1] < off[1:]]  # first bytes of texts that aren't empty
    st[at] = word[at]
    last = off[1:][off[:-1] < off[1:]] - 1
    en[last] = word[last]
    starts, ends = np.flatnonzero(st), np.flatnonzero(en) + 1
    return Words(data, starts, ends, np.searchsorted(starts, off))


def word_hashes(w: Words, lower: bool = False) -> np.ndarray:
    """64-bit hash of each word's bytes (polynomial in random byte codes, then mixed); of A-Z in lower case if wanted."""
    if not len(w.starts):
        return np.zeros(0, np.uint64)
    p = _powers(_BYTE_BASE, len(w.data))
    total = np.zeros(len(w.data) + 1, np.uint64)
    np.cumsum((_BYTE[_LOWER] if lower else _BYTE)[w.data] * p, out=total[1:])
    inverse = _powers(pow(_BYTE_BASE, -1, 1 << 64), len(w.data))
    return fmix64((total[w.ends] - total[w.starts]) * inverse[w.starts])


def window_hashes(hashes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of the n words from each word index in `at`."""
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * _powers(_WORD_BASE, len(hashes)), out=total[1:])
    inverse = _powers(pow(_WORD_BASE, -1, 1 << 64), len(hashes) + 1)
    return fmix64((total[at + n] - total[at]) * inverse[at] + np.uint64(n))


def joined(w: Words, lower: bool = False) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Words joined by one space, with the byte ranges of the words in that; A-Z in lower case if wanted."""
    if not len(w.starts):
        return b"", w.starts, w.ends
    sep = _SEP[w.data]
    keep = ~sep
    keep[1:] |= sep[1:] & ~sep[:-1]
    out = np.where(sep, np.uint8(32), _LOWER[w.data] if lower else w.data)[keep]
    at = np.cumsum(keep) - 1
    starts = at[w.starts]
    return out.tobytes(), starts, at[w.ends - 1] + 1
