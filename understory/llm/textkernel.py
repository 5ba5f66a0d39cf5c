"""Array kernels over Arrow string batches: words, word hashes and shingles.

All functions work on the UTF-8 bytes of whole texts.  A *word* is a maximal run
of ``[0-9a-z]`` (after lower-casing A-Z) and bytes from 0x80, which is the
pattern ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` on lower-cased text.  Python loops
run over documents at most, never over words or characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from understory.llm.common import held

#: Text bytes taken up at once; a longer single text is one slice of its own.
SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _word_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    keep = np.zeros(256, bool)
    keep[48:58] = keep[97:123] = keep[65:91] = keep[128:] = True
    table[~keep] = 0
    return table


#: Byte to lower-cased word byte, 0 for separators.
WORD_BYTE = _word_table()

#: Byte to itself, 0 for ASCII white space: tokens with case and punctuation.
TOKEN_BYTE = np.where(np.isin(np.arange(256), (0, 9, 10, 11, 12, 13, 32)), 0, np.arange(256)).astype(np.uint8)

def _power(base: np.uint64, n: int) -> np.ndarray:
    """The first n powers of base modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, out=out)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse; kept for a slice's length."""
    if n > SLICE_BYTES:
        return _power(_BASE, n), _power(_INVERSE, n)
    both = held("powers", lambda: (_power(_BASE, SLICE_BYTES), _power(_INVERSE, SLICE_BYTES)))
    return both[0][:n], both[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, element by element."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null texts have no bytes."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of rows with about `limit` bytes."""
    raw, offsets = string_buffers(column)
    first, n = 0, len(column)
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(n, max(end, first + 1))
        yield first, end, raw[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


@dataclass
class Words:
    """Words of consecutive texts: hash, byte start and end of each; bounds[i]:bounds[i+1] are text i's."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def words(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray = WORD_BYTE) -> Words:
    """All words of the texts whose bytes are raw[offsets[i]:offsets[i + 1]]; table gives 0 for separators."""
    n = len(raw)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64))
    low = table[raw]
    inside = low != 0
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < n]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    last = offsets[1:]
    after[last[last > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    total = np.zeros(n + 1, np.uint64)
    forward, inverse = _powers(n)
    value = low.astype(np.uint64)
    value += np.uint64(1)
    value *= forward
    np.cumsum(value, out=total[1:])
    hashes = mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets))


def shingles(found: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): every run of k words of each text; a text of 1 to k - 1 words is one run."""
    n, counts = len(found.hashes), found.counts
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(found.bounds), np.int64)
    full = max(n - k + 1, 0)
    value = np.zeros(full, np.uint64)
    for i in range(k):
        value *= _STEP
        value += found.hashes[i : i + full]
    runs = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    bounds = np.zeros(len(runs) + 1, np.int64)
    np.cumsum(runs, out=bounds[1:])
    at = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - found.bounds[:-1], runs)
    short = np.flatnonzero((counts > 0) & (counts < k))
    out = np.empty(bounds[-1], np.uint64)
    long = np.repeat(counts >= k, runs)
    out[long] = value[at[long]]
    for i in short:
        h = np.uint64(counts[i])
        with np.errstate(over="ignore"):
            for x in found.hashes[found.bounds[i] : found.bounds[i + 1]]:
                h = h * _STEP + x
        out[bounds[i]] = h
    return mix(out), bounds


def spans(found: Words, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the runs of words first[i]:end[i]."""
    n = len(found.hashes)
    total = np.zeros(n + 1, np.uint64)
    forward, inverse = _powers(n) if n else (total, total)
    np.cumsum(found.hashes * forward[:n], out=total[1:])
    return mix((total[end] - total[first]) * inverse[first] + (end - first).astype(np.uint64))
