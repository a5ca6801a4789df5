"""Words of whole texts as numpy arrays, cut from Arrow buffers without a Python object per word.

A batch of texts is read in slices of a few hundred kilobytes (a longer text is one slice), so memory does
not grow with the batch. A word's hash is a 64-bit polynomial of its bytes, taken from one running sum over
the slice, and then mixed; equal words have equal hashes at every place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def mixed(value: int) -> int:
    return int(mix(np.array([value % (1 << 64)], np.uint64))[0])


def _byte_values() -> np.ndarray:
    """One value per byte; capital ASCII letters share that of their small letter."""
    lowered = np.frombuffer(bytes(range(256)).lower(), np.uint8).astype(np.uint64)
    return mix(lowered + np.uint64(1))


_VALUES = _byte_values()

#: Bytes that are part of a word.
#: Letters, digits and everything beyond ASCII, as in [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z became a-z.
ALNUM = np.array([b > 127 or chr(b).isalnum() for b in range(256)])
#: All but white space, as in [^\x20\x09-\x0D]+.
SOLID = np.array([b != 0x20 and not 0x09 <= b <= 0x0D for b in range(256)])


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers[0][:n], _powers[1][:n]


@dataclass
class Words:
    """The words of the texts ``first .. first + len(counts)`` of a batch, in order."""

    first: int
    counts: np.ndarray  # words per text
    starts: np.ndarray  # byte places in data
    ends: np.ndarray
    hashes: np.ndarray
    data: np.ndarray  # bytes of the slice
    offsets: np.ndarray  # byte place of each text, and the end

    @property
    def firsts(self) -> np.ndarray:
        """Place of each text's first word, and the end."""
        return np.concatenate([[0], np.cumsum(self.counts)])

    @property
    def texts(self) -> np.ndarray:
        """Text of each word, counted from 0 in this slice."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def lowered(self, word: int, length: int = 1) -> bytes:
        """Bytes from a word's start to the end of the last of ``length`` words, in small ASCII letters."""
        return self.data[self.starts[word] : self.ends[word + length - 1]].tobytes().lower()


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string or binary column; a null text is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return places, held


def slices(places: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``most`` bytes."""
    first, n = 0, len(places) - 1
    while first < n:
        last = int(np.searchsorted(places, places[first] + most, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


def words(column: pa.Array, inside: np.ndarray, most: int = SLICE_BYTES) -> Iterator[Words]:
    """The words of every text of a column, slice by slice."""
    places, held = text_buffers(column)
    for first, last in slices(places, most):
        base, end = int(places[first]), int(places[last])
        data, offsets = held[base:end], places[first : last + 1] - base
        yield _cut(first, data, offsets, inside)


def _cut(first: int, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> Words:
    n = len(data)
    texts = len(offsets) - 1
    if not n:
        none = np.zeros(0, np.int64)
        return Words(first, np.zeros(texts, np.int64), none, none, np.zeros(0, np.uint64), data, offsets)
    part = inside[data]
    begins, stops = part.copy(), part.copy()
    begins[1:] &= ~part[:-1]
    stops[:-1] &= ~part[1:]
    edges = offsets[:-1][offsets[:-1] < n]
    begins[edges] = part[edges]
    inner = edges[edges > 0]
    stops[inner - 1] = part[inner - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    powers, inverse = _power_tables(n + 1)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_VALUES[data] * powers[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts])
    counts = np.diff(np.searchsorted(starts, offsets))
    return Words(first, counts, starts, ends, hashes, data, offsets)


def word_hashes(text: bytes, inside: np.ndarray) -> np.ndarray:
    return _cut(0, np.frombuffer(text, np.uint8), np.array([0, len(text)]), inside).hashes


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every ``length`` consecutive words; one entry per first word that has enough after it."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:n].copy()
    for k in range(1, length):
        total *= np.uint64(_BASE)
        total += hashes[k : k + n]
    return mix(total)


class HashSet:
    """Membership of 64-bit hashes: a bit table turns most away, a sorted search settles the rest."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        bits = max(10, min(24, (16 * len(self.keys)).bit_length()))
        self.mask = np.uint64((1 << bits) - 1)
        self.seen = np.zeros(1 << bits, bool)
        self.seen[self.keys & self.mask] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``hashes`` that are keys, and their places in ``self.keys``."""
        if not len(self.keys):
            none = np.zeros(0, np.int64)
            return none, none
        maybe = np.flatnonzero(self.seen[hashes & self.mask])
        at = np.searchsorted(self.keys, hashes[maybe])
        at[at == len(self.keys)] = 0
        sure = self.keys[at] == hashes[maybe]
        return maybe[sure], at[sure]
