"""Words of whole Arrow batches as numpy arrays: no Python object per word.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``.  These separators are ASCII, so cutting UTF-8 bytes cuts
code points nowhere.  Words, shingles and windows are represented by 64-bit fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finalizer of splitmix64: a bijection that spreads every bit."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers made from ``seed``."""
    return mix(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed)) | _U(1)


_BYTE = constants(256, 11)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE[_SPACE] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = _U(0xD6E8FEB86659FD93)
_STEP_INVERSE = _U(pow(0xD6E8FEB86659FD93, -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), dtype=_U)
    done = 1
    step = _U(base)
    with np.errstate(over="ignore"):
        while done < n:
            more = min(done, n - done)
            out[done : done + more] = out[:more] * step
            step = step * step
            done += more
    return out[:n]


@dataclass
class Words:
    """Words of some texts: ``hashes`` in order, and where each text's words begin (``first`` has one more entry)."""

    hashes: np.ndarray
    first: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values of a string column, and the offsets of the values; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if len(offsets) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from row, to row, bytes, offsets) of runs of about ``size`` bytes; a longer text is a run of its own."""
    data, offsets = utf8(column)
    n, row = len(offsets) - 1, 0
    while row < n:
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1)
        yield row, to, data[offsets[row] : offsets[to]], offsets[row : to + 1] - offsets[row]
        row = to


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False, separators: np.ndarray = _SPACE) -> Words:
    """Find and fingerprint the words of the texts ``data[offsets[i]:offsets[i+1]]``.

    ``separators`` flags the 256 byte values that end a word: white space, or white space and more.
    """
    if lower:
        data = _LOWER[data]
    n = len(data)
    inside = ~separators[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < n]
    begins[heads] = inside[heads]
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    finishes[tails] = inside[tails]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    first = np.searchsorted(starts, offsets)
    if len(starts) == 0:
        return Words(np.empty(0, _U), first, starts, ends, data)
    lengths = np.diff(np.append(starts, n))
    place = np.arange(starts[0], n) - np.repeat(starts, lengths)
    table = powers(_STEP, int((ends - starts).max()) + 1)
    # behind a word's end only separators follow, which count as 0
    place = np.minimum(place, len(table) - 1)
    values = np.where(separators, _U(0), _BYTE)[data[starts[0] :]] * table[place]
    hashes = np.add.reduceat(values, starts - starts[0])
    return Words(mix(hashes + (ends - starts).astype(_U)), first, starts, ends, data)


def number_of_words(data: np.ndarray, offsets: np.ndarray) -> int:
    """How many words the texts have, without fingerprints."""
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    begins[heads] = inside[heads]
    return int(np.count_nonzero(begins))


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """Fingerprints of all runs of ``length`` consecutive words, the first at word 0; short runs by addition."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, _U)
    if length <= 8:
        out = np.zeros(n, _U)
        for j, factor in enumerate(constants(length, 23)):
            out += hashes[j : j + n] * factor
        return mix(out)
    total = np.zeros(len(hashes) + 1, _U)
    np.cumsum(hashes * powers(_STEP_INVERSE, len(hashes)), out=total[1:])
    return mix((total[length:] - total[:-length]) * powers(_STEP, n))


def run_starts(first: np.ndarray, length: int) -> np.ndarray:
    """Word numbers at which a run of ``length`` words begins that stays within its text."""
    n = int(first[-1])
    room = np.repeat(first[1:], np.diff(first)) - np.arange(n)
    return np.flatnonzero(room >= length)


def pack(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()
