"""Whole texts of an Arrow batch as byte arrays, cut into words, with 64-bit hashes of spans and of fixed windows.

All functions take slices of a few megabytes of UTF-8, so that temporary arrays stay small. A text longer than a slice
gets a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


@dataclass
class Texts:
    """Consecutive texts: text ``i`` is ``data[offsets[i]:offsets[i + 1]]``; a null text is empty."""

    rows: pa.RecordBatch
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def sizes(self) -> np.ndarray:
        return np.diff(self.offsets)

    def count(self, mask: np.ndarray) -> np.ndarray:
        """How many bytes of each text the mask marks."""
        return per_range(mask, self.offsets)


def per_range(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many marked items each range ``offsets[i]:offsets[i + 1]`` has."""
    at = np.flatnonzero(mask)
    return np.diff(np.searchsorted(at, offsets))


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[Texts]:
    for batch in batches:
        column = batch.column(text)
        if column.null_count:
            column = pc.fill_null(column, "")
        column = column.cast(pa.large_string())
        if not len(column):
            continue
        _, offset_buffer, data_buffer = column.buffers()
        offsets = np.frombuffer(offset_buffer, np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(data_buffer, np.uint8) if data_buffer else np.zeros(0, np.uint8)
        first = 0
        while first < len(column):
            last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
            last = min(max(last, first + 1), len(column))
            cut = offsets[first : last + 1]
            yield Texts(batch.slice(first, last - first), data[cut[0] : cut[-1]], cut - cut[0])
            first = last


@dataclass
class Words:
    """Words of all texts of a slice: byte ranges, and the range of words of each text."""

    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts())


def words(texts: Texts, breaks: np.ndarray = SPACE) -> Words:
    """Maximal runs of bytes outside ``breaks`` (a table of 256 flags), never across texts."""
    inside = ~breaks[texts.data]
    n = len(inside)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(len(texts) + 1, np.int64))
    edge = np.zeros(n + 1, bool)
    edge[texts.offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(starts, ends, np.searchsorted(starts, texts.offsets))


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which each input bit reaches all output bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


def _prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    forward, back = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * forward[: len(data)], out=sums[1:])
    return sums, back


def rolling_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """``span_hashes`` of all ranges of ``length`` bytes."""
    sums, back = _prefix_sums(data)
    spans = (sums[length:] - sums[:-length]) * back[: len(sums) - length]
    return mix(spans + mix(np.full(1, length, np.uint64)))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range; equal content and length give equal hashes wherever the range lies."""
    sums, back = _prefix_sums(data)
    spans = (sums[ends] - sums[starts]) * back[starts]
    return mix(spans + mix((ends - starts).astype(np.uint64)))


def window_hashes(values: np.ndarray, length: int) -> np.ndarray:
    """Hash of ``values[i:i + length]`` for every ``i`` where the window fits, by doubling."""
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    result, done, block, size = None, 0, values, 1
    while True:
        if length & size:
            part = block[done : done + n]
            result = mix(part + np.uint64(1)) if result is None else mix(result * _BASE + part)
            done += size
        if done == length:
            return result
        block = mix(block[:-size] * _BASE + block[size:])
        size *= 2


def to_long(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)
