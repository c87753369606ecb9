"""Vectorised work on the UTF-8 bytes of Arrow text columns: slicing, words, 64-bit hashes."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are handled in slices of about this many bytes; one longer text makes a slice of its own.
SLICE_BYTES = 1 << 19
SLICE_ROWS = 16_384
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.int64).astype(U) * U(2) + U(1)


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2 ... modulo 2^64."""
    out = np.ones(max(n, 1), U)
    done = 1
    while done < n:
        step = U(pow(base, done, 1 << 64))
        more = min(done, n - done)
        out[done:done + more] = out[:more] * step
        done += more
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit words."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


def give_back() -> None:
    """Return freed memory to the system: Python workers outlive their tasks, and executors share their memory with them."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, offsets from 0, bytes) of slices of a text column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    n = len(column)
    if not n:
        return
    _, ends, data = column.buffers()
    offs = np.frombuffer(ends, wide)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n, lo + SLICE_ROWS)
        yield lo, hi, offs[lo:hi + 1] - offs[lo], raw[offs[lo]:offs[hi]]
        lo = hi
    give_back()


def word_bounds(data: np.ndarray, offs: np.ndarray, gap: np.ndarray | None = None):
    """Starts and ends of words, and the word offsets of the texts (one more than texts)."""
    gap = SPACE[data] if gap is None else gap
    n = len(data)
    first = np.ones(n + 1, bool)
    first[1:n] = gap[:-1]
    first[offs] = True
    starts = np.flatnonzero(first[:n] & ~gap)
    last = np.ones(n + 1, bool)
    last[1:n] = gap[1:]
    last[offs] = True
    ends = np.flatnonzero(last[1:] & ~gap) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(data: np.ndarray, offs: np.ndarray, gap: np.ndarray | None = None):
    """64-bit hashes of the words with A-Z lower-cased, and the word offsets of the texts."""
    gap = SPACE[data] if gap is None else gap
    starts, ends, of_text = word_bounds(data, offs, gap)
    if not len(starts):
        return np.zeros(0, U), of_text
    value = _BYTE[LOWER[data]]
    value *= powers(_BASE, len(data))
    value[gap] = 0
    h = np.add.reduceat(value, starts)
    h *= powers(_INVERSE, len(data))[starts]
    return mix(h + (ends - starts).astype(U)), of_text


def shingle_sets(data: np.ndarray, offs: np.ndarray, width: int = 3) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles of ``width`` words.

    A text with fewer words has its whole sequence as the only shingle, a text
    without words has none.
    """
    words, of_text = word_hashes(data, offs)
    n = len(words)
    rolled = np.zeros(n, U)
    for k in range(width):
        factor = U(pow(0xD6E8FEB86659FD93, k + 1, 1 << 64))
        rolled[:max(n - k, 0)] += words[k:] * factor
    rolled = mix(rolled)
    out = []
    for lo, hi in zip(of_text[:-1], of_text[1:], strict=True):
        if hi - lo >= width:
            out.append(np.unique(rolled[lo:hi - width + 1]))
        elif hi > lo:
            short = np.full(1, hi - lo, U)
            for k in range(lo, hi):
                short = mix(short * U(3) + words[k:k + 1])
            out.append(short)
        else:
            out.append(np.zeros(0, U))
    return out
