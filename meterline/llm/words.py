"""Words of many texts at once: bounds and hashes in numpy, without a Python object for each word.

A word's hash is a polynomial over random numbers, one for each byte value, taken from running sums; its places don't
matter. Bytes are worked on in segments that end between words, so memory follows the segment and the longest word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from meterline.llm.blocks import mixed

SEGMENT = 1 << 20
BASE = 0x9E3779B97F4A7C15
_RNG = np.random.default_rng(20240611)
#: A random number for each byte value; two tables for two hashes that know nothing of each other.
TABLES = _RNG.integers(0, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: A-Z in lower case, all other bytes as they are.
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """The first n powers of BASE and of its inverse modulo 2^64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            factors = np.full(n, base, np.uint64)
            factors[0] = 1
            _powers[k] = np.multiply.accumulate(factors)
    return _powers


@dataclass
class Words:
    """Words of some texts in a row: where each begins and ends in data, its text, and its hashes; sizes has the words of each text."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    sizes: np.ndarray
    hashes: list[np.ndarray]

    def joined(self, at: int, n: int) -> bytes:
        """n words from the at-th on, with one space between."""
        raw = self.data.data
        return b" ".join(bytes(raw[a:z]) for a, z in zip(self.start[at : at + n].tolist(), self.end[at : at + n].tolist()))

    def whole(self, size: int, group: np.ndarray | None = None) -> np.ndarray:
        """Whether the so many words from each on lie in one text, or in one run of equal numbers of group."""
        group = self.text if group is None else group
        n = max(0, len(group) - size + 1)
        return group[:n] == group[size - 1 : size - 1 + n]


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of strings in a row, and where each begins, with the end. A null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def segments(in_word: np.ndarray, size: int = SEGMENT) -> Iterator[tuple[int, int]]:
    """Cuts into about so many bytes, at places that no word goes over."""
    begin, n = 0, len(in_word)
    while begin < n:
        end = begin + size
        while end < n and in_word[end]:
            out = np.flatnonzero(~in_word[end : end + size])
            end = end + int(out[0]) if len(out) else end + size
        yield begin, min(end, n)
        begin = min(end, n)


def scan(column: pa.Array, word_bytes: np.ndarray, n_hashes: int = 1) -> Words:
    """All words of a column of texts: runs of bytes for which word_bytes holds. A-Z count and are hashed in lower case."""
    data, bounds = bytes_of(column)
    data = LOWER[data]
    in_word = word_bytes[data]
    first = np.zeros(len(data) + 1, bool)
    first[bounds] = True  # a text's first byte begins a word whatever stands before it
    starts, ends, hashes = [], [], [[] for _ in range(n_hashes)]
    for a, z in segments(in_word):
        own = in_word[a:z]
        begins, stops = own.copy(), own.copy()
        begins[1:] &= ~own[:-1] | first[a + 1 : z]
        stops[:-1] &= ~own[1:] | first[a + 1 : z]
        start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        up, down = powers(z - a)
        for k in range(n_hashes):
            sums = np.zeros(z - a + 1, np.uint64)
            np.cumsum(TABLES[k][data[a:z]] * up[: z - a], out=sums[1:])
            hashes[k].append(mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * TABLES[k][0]))
        starts.append(start + a)
        ends.append(end + a)
    start, end = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (starts, ends))
    sizes = np.diff(np.searchsorted(start, bounds))
    return Words(data, start, end, np.repeat(np.arange(len(sizes)), sizes), sizes, [np.concatenate([np.zeros(0, np.uint64), *x]) for x in hashes])


def slices(batch: pa.RecordBatch | pa.Table, column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch | pa.Table]:
    """Runs of rows with at most so many bytes in a column, one row at least."""
    sizes = np.array([len(v.as_buffer()) if v.is_valid else 0 for v in batch[column].cast(pa.large_binary())], np.int64)
    begin, held = 0, 0
    for k, size in enumerate(sizes.tolist()):
        if k > begin and held + size > most_bytes:
            yield batch.slice(begin, k - begin)
            begin, held = k, 0
        held += size
    if len(sizes) > begin:
        yield batch.slice(begin)
