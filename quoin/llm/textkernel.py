"""Words, word hashes and window hashes of whole Arrow batches, without a Python loop over words.

A text column becomes one byte buffer. Words are runs of bytes outside `[\\x20\\x09-\\x0D]`
(all ASCII, so UTF-8 continuation bytes never match). A word's hash is a polynomial over its bytes,
taken from prefix sums modulo 2**64; a window's hash is a second
polynomial over the mixed hashes of its words. Both are functions of the words alone.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: Bytes handled at once; longer buffers are cut at white space.
SEGMENT = 1 << 18
#: Bytes of text that an operator takes from an Arrow batch at once; a longer text is a part of its own.
PART_BYTES = 1 << 21


def lean() -> None:
    """Gives memory that was freed back to the system, so a worker doesn't keep through a stage what the one before held."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


_LIBC = ctypes.CDLL(None)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values (multiply and xor-shift rounds)."""
    x = (x + U((0x9E3779B97F4A7C15 * (seed + 1)) % (1 << 64))).astype(U, copy=False)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base % (1 << 64), dtype=U)
        steps[0] = 1
        have = _POWERS[base] = np.cumprod(steps, dtype=U)
    return have[:n]


_P = 0x9E3779B97F4A7C55
_P_INV = pow(_P, -1, 1 << 64)
_Q = 0xD6E8FEB86659FD93
_Q_INV = pow(_Q, -1, 1 << 64)


@dataclass
class Words:
    data: np.ndarray  # bytes of all texts, end to end
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray  # byte after each word
    first: np.ndarray  # number of the first word of each text, and the number of all words
    hashes: np.ndarray | None

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column and the offsets of its values; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, dtype=np.int64)
    raw = column.buffers()[2] if len(column) else None
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, dtype=np.uint8)
    return data, offsets - offsets[0]


def parts(batch: pa.RecordBatch, column: int, most: int = PART_BYTES, rows: int = 1 << 62) -> Iterator[pa.RecordBatch]:
    """The rows of batch in order, in slices of about `most` bytes of a string column and at most `rows` rows; texts stay whole."""
    filled = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        to = min(at + rows, max(at + 1, int(np.searchsorted(filled, (filled[at - 1] if at else 0) + most, side="right"))))
        yield batch.slice(at, to - at)
        at = to


def words(column, lower: bool = False, hashed: bool = True) -> Words:
    data, offsets = buffer(column)
    if lower:
        data = _LOWER[data]
    blank = data - np.uint8(9) < np.uint8(5)  # wraps below 9
    blank |= data == np.uint8(32)
    edge = np.empty(len(data) + 1, dtype=bool)
    edge[0] = True
    edge[1:] = blank
    heads = offsets[:-1][offsets[:-1] < len(data)]
    edge[heads] = True
    starts = np.flatnonzero(~blank & edge[:-1])
    stop = np.empty(len(data) + 1, dtype=bool)  # stop[i]: no word runs from byte i-1 into byte i
    stop[:-1] = blank
    stop[-1] = True
    stop[heads] = True
    ends = np.flatnonzero(~blank & stop[1:]) + 1
    first = np.searchsorted(starts, offsets)
    out = Words(data, starts, ends, first, None)
    if hashed:
        out.hashes = word_hashes(out)
    return out


def word_hashes(w: Words) -> np.ndarray:
    """One 64-bit hash for each word, in segments of about SEGMENT bytes that end with a word."""
    out, at, n = np.empty(len(w.starts), dtype=U), 0, len(w.starts)
    while at < n:
        to = max(at + 1, int(np.searchsorted(w.starts, w.starts[at] + SEGMENT)))
        low, high = w.starts[at], w.ends[to - 1]
        sums = np.zeros(high - low + 1, dtype=U)
        np.cumsum(np.multiply(w.data[low:high], powers(_P, high - low), dtype=U), out=sums[1:])
        s, e = w.starts[at:to] - low, w.ends[at:to] - low
        out[at:to] = mix((sums[e] - sums[s]) * powers(_P_INV, high - low + 1)[s] + (e - s).astype(U), 1)
        at = to
    return out


def windows(hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hashes of all runs of `size` words; those that cross texts are for the caller to leave out."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=U)
    sums = np.zeros(len(hashes) + 1, dtype=U)
    np.cumsum((mix(hashes, seed) if seed else hashes) * powers(_Q, len(hashes)), out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * powers(_Q_INV, n), 3 + seed)


def window_starts(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers at which a window of `size` words begins inside one text, and the text of each."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    before = np.cumsum(counts) - counts
    return np.arange(len(text)) - before[text] + first[:-1][text], text


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n words lie in a window of `size` words that begins at one of starts."""
    delta = np.zeros(n + 1, dtype=np.int32)
    np.add.at(delta, starts, 1) if len(starts) < 64 else delta.__iadd__(np.bincount(starts, minlength=n + 1).astype(np.int32))
    delta -= np.bincount(starts + size, minlength=n + 1).astype(np.int32)[: n + 1] if len(starts) else 0
    return np.cumsum(delta[:n]) > 0


def lookup(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """values at the place of each asked key in the sorted distinct keys, 0 where it is missing."""
    out = np.zeros(len(asked), dtype=values.dtype)
    if len(keys) and len(asked):
        bits = max(10, min(26, int(len(keys)).bit_length() + 3))
        slot = U(64 - bits)
        seen = np.zeros(1 << bits, dtype=bool)
        seen[(keys * U(0x9E3779B97F4A7C15)) >> slot] = True
        maybe = np.flatnonzero(seen[(asked * U(0x9E3779B97F4A7C15)) >> slot])
        some = asked[maybe]
        place = np.minimum(np.searchsorted(keys, some), len(keys) - 1)
        hit = keys[place] == some
        out[maybe[hit]] = values[place[hit]]
    return out


def tally(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and how often each occurs (by sorting; faster here than a hash table)."""
    values = np.sort(values)
    if not len(values):
        return values, np.zeros(0, dtype=np.int64)
    at = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return values[at], np.diff(np.append(at, len(values)))
