"""Words and shingles of whole texts as flat numpy arrays, one pass over the bytes of an Arrow batch."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
"""The bytes between words, everywhere in this folder: [\\x20\\x09-\\x0D]."""
try:
    _LIBC = ctypes.CDLL("libc.so.6")
except OSError:
    _LIBC = None
STEP = 1 << 20
"""Bytes that are hashed at a time, so that 8-byte work arrays stay small however long a text is."""
_U = np.uint64
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over all output bits."""
    x = np.asarray(x, dtype=_U)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Rolling:
    """Polynomial (Rabin-Karp) hashes modulo 2**64 of ranges of a sequence, from one prefix sum.

    For short ranges of hashed values alone, as windows of words are: of sequences of 512 and more there are different ones
    with one hash, whatever the base.
    """

    def __init__(self, seed: int):
        base = int(mix(np.array([seed + 0x9E3779B97F4A7C15], dtype=_U))[0]) | 5
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up, self.down = self._powers(self.base, 1), self._powers(self.inverse, 1)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.empty(n, dtype=_U)
        out[0] = 1
        have = 1
        while have < n:
            take = min(have, n - have)
            out[have:have + take] = out[:take] * _U(pow(base, have, 1 << 64))
            have += take
        return out

    def ranges(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of values[start:end] for every range; equal ranges have equal hashes wherever they are."""
        n = len(values) + 1
        if len(self.up) < n:
            self.up, self.down = self._powers(self.base, n), self._powers(self.inverse, n)
        sums = np.zeros(n, dtype=_U)
        np.cumsum(values * self.up[:n - 1], out=sums[1:])
        return (sums[ends] - sums[starts]) * self.down[starts]


_OVER_WORDS = {seed: Rolling(seed + 100) for seed in (0, 1)}
SHORT = 64
"""Bytes of a range up to which its hash is put together eight at a time; a longer one goes to BLAKE2."""
_SEEDS = {seed: int(mix(np.array([(2 * seed + 1) * 0x9E3779B97F4A7C15 & _MASK], dtype=_U))[0]) for seed in (0, 1)}
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=_U)


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of every byte range, from its bytes alone; ranges ascend and do not overlap.

    Every eight bytes go through ``mix``, so that, other than in a polynomial modulo 2**64, no pattern of bytes takes the
    differences of two texts out again.
    """
    out, lengths = np.empty(len(starts), dtype=_U), ends - starts
    start = _U(_SEEDS[seed])
    i = 0
    while i < len(out):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + STEP, side="right")))
        low, high = int(starts[i]), int(ends[j - 1])
        if j > i + 1 or high - low <= SHORT:
            padded = np.zeros(high - low + 8, dtype=np.uint8)
            padded[:high - low] = data[low:high]
            eights = np.ndarray(high - low + 1, dtype="<u8", buffer=padded, strides=(1,))
            at, left = starts[i:j] - low, np.minimum(lengths[i:j], SHORT)
            state = np.full(j - i, start, dtype=_U)
            some = np.flatnonzero(left > 0)
            for place in range(0, SHORT, 8):
                if not len(some):
                    break
                state[some] = mix((state[some] + start) ^ (eights[at[some] + place] & _KEEP[np.minimum(left[some] - place, 8)]))
                some = some[left[some] > place + 8]
            out[i:j] = state
        i = j
    for at in np.flatnonzero(lengths > SHORT).tolist():
        digest = hashlib.blake2b(data[starts[at]:ends[at]], digest_size=8, key=_SEEDS[seed].to_bytes(8, "little")).digest()
        out[at] = int.from_bytes(digest, "little")
    return mix(out + lengths.astype(_U) * _U(0x9E3779B97F4A7C15))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def trim() -> None:
    """Give memory that was freed back to the machine; a Python worker lives on between tasks."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def separators(chars: bytes = SPACES) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(chars)] = True
    return table


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column in one byte array, and the n + 1 offsets; a null text is empty."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = array.chunk(0) if array.num_chunks else pa.array([], array.type)
    array = array.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = array.buffers()
    if not len(array):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    offsets = np.frombuffer(offsets, dtype=np.int64)[array.offset:array.offset + len(array) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words of a run of documents: byte ranges in ``data``, and the first word of each document."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    """n_docs + 1 word numbers; words of document d are first[d]:first[d + 1]."""

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash for each word, from its bytes alone."""
        return byte_hashes(self.data, self.starts, self.ends, seed)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def split_words(data: np.ndarray, offsets: np.ndarray, between: np.ndarray | None = None) -> Words:
    """Words are the longest runs of bytes that are not separators; none crosses a document's end."""
    inside = ~(separators() if between is None else between)[data]
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return Words(data, none, none, np.zeros(len(offsets), dtype=np.int64))
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    bounds = offsets[1:-1]
    bounds = bounds[(bounds > 0) & (bounds < len(data))]
    opens[bounds] = inside[bounds]
    closes[bounds - 1] = inside[bounds - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def window_starts(first: np.ndarray, width: int) -> np.ndarray:
    """Word numbers at which a window of ``width`` words of one document starts, ascending."""
    counts = np.maximum(np.diff(first) - width + 1, 0)
    if not counts.sum():
        return np.zeros(0, dtype=np.int64)
    shift = first[:-1] - np.concatenate(([0], np.cumsum(counts)[:-1]))
    return np.arange(counts.sum()) + np.repeat(shift, counts)


def window_hashes(word_hashes: np.ndarray, starts: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Rabin-Karp hash of every window, mixed so that its top bits are spread evenly."""
    return mix(_OVER_WORDS[seed].ranges(word_hashes, starts, starts + width) + _U(width))


def shingle_sets(words: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every document, ascending in each, and n_docs + 1 offsets.

    A document of fewer than ``width`` words has its whole sequence as its only shingle; one without
    words has none.
    """
    hashes = words.hashes()
    starts = window_starts(words.first, width)
    owner = words.owner()
    values, owners = [window_hashes(hashes, starts, width)], [owner[starts]]
    counts = words.counts
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        low, high = words.first[short], words.first[short + 1]
        values.append(mix(_OVER_WORDS[0].ranges(hashes, low, high) + (high - low).astype(_U)))
        owners.append(short)
    value, own = np.concatenate(values), np.concatenate(owners)
    if len(short):
        order = np.argsort(own, kind="stable")
        value, own = value[order], own[order]
    ends = np.searchsorted(own, np.arange(len(words.first)))
    for low, high in zip(ends[:-1].tolist(), ends[1:].tolist()):
        value[low:high].sort()
    keep = np.ones(len(value), dtype=bool)
    keep[1:] = (value[1:] != value[:-1]) | (own[1:] != own[:-1])
    value, own = value[keep], own[keep]
    return value, np.searchsorted(own, np.arange(len(words.first)))


def slices(offsets: np.ndarray, most: int = STEP) -> Iterator[tuple[int, int]]:
    """Runs of documents of at most ``most`` bytes together, or one longer document."""
    i, n = 0, len(offsets) - 1
    trim()
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, j
        i = j
