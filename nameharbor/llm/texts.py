"""Texts of one Arrow batch as a byte buffer with offsets, for vectorised work inside a task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Zero bytes after the last text, so that eight bytes can be loaded at any place.
PAD = 64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(8)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def loads(buf: np.ndarray) -> np.ndarray:
    """The little-endian 64-bit number that starts at each byte."""
    return np.ndarray((len(buf) - 7,), "<u8", buf, strides=(1,))


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of a padded buffer."""
    at, left, all_loads = starts.astype(np.int64), (ends - starts).astype(np.int64), loads(buf)
    out = mix(left.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    live = np.flatnonzero(left > 0)
    at, left = at[live], left[live]
    while live.size:
        word = all_loads[at]
        short = np.flatnonzero(left < 8)
        word[short] &= _MASKS[left[short]]
        out[live] = mix(out[live] * np.uint64(3) + word)
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    return out


class Texts:
    """``buf`` holds all texts end to end; text ``i`` is ``buf[starts[i]:ends[i]]``. Null texts are empty."""

    def __init__(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.buf, self.starts, self.ends = buf, starts, ends

    @classmethod
    def of(cls, column: pa.Array | pa.ChunkedArray) -> Texts:
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):  # of no chunk
            column = pa.array([], pa.string())
        if pa.types.is_string(column.type):
            column = column.cast(pa.large_string())
        elif pa.types.is_binary(column.type):
            column = column.cast(pa.large_binary())
        _, places, data = column.buffers()
        n = len(column)
        at = np.frombuffer(places, np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
        size = int(at[-1] - at[0])
        buf = np.zeros(size + PAD, np.uint8)
        if size:
            buf[:size] = np.frombuffer(data, np.uint8, size, int(at[0]))
        at = at - at[0]
        starts, ends = at[:-1].copy(), at[1:].copy()
        if column.null_count:
            gone = column.is_null().to_numpy(zero_copy_only=False)
            ends[gone] = starts[gone]
        return cls(buf, starts, ends)

    @classmethod
    def joined(cls, data: bytes, sizes: np.ndarray) -> Texts:
        buf = np.zeros(len(data) + PAD, np.uint8)
        buf[: len(data)] = np.frombuffer(data, np.uint8)
        ends = np.cumsum(sizes, dtype=np.int64)
        return cls(buf, ends - sizes, ends)

    def __len__(self) -> int:
        return len(self.starts)

    def lowered(self) -> Texts:
        """A-Z in lower case."""
        return Texts(_LOWER[self.buf], self.starts, self.ends)

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each maximal run without white space (0x20, 0x09-0x0D), cut between texts."""
        blank = _SPACE[self.buf]
        blank[len(blank) - PAD:] = True
        full = self.starts < self.ends
        before = np.empty_like(blank)
        before[0], before[1:] = True, blank[:-1]
        before[self.starts[full]] = True
        after = np.empty_like(blank)
        after[-1], after[:-1] = True, blank[1:]
        after[self.ends[full] - 1] = True
        inside = ~blank
        return np.flatnonzero(inside & before), np.flatnonzero(inside & after) + 1

    def within(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of sorted places: the index of the first one in each text, and of the first one after it."""
        first = np.searchsorted(places, self.starts)
        return first, np.maximum(first, np.searchsorted(places, self.ends))

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each line (split at \\n) and the text it is in. An empty text has one line."""
        breaks = np.flatnonzero(self.buf[: len(self.buf) - PAD] == 10)
        first, last = self.within(breaks)
        of = np.repeat(np.arange(len(self)), last - first)
        breaks = breaks[_ranges(first, last)]
        before = np.cumsum(last - first) - (last - first)
        n, docs = len(self) + len(breaks), np.arange(len(self))
        starts, ends, text = np.empty(n, np.int64), np.empty(n, np.int64), np.empty(n, np.int64)
        head, slot = docs + before, np.arange(len(breaks)) + of
        starts[head], starts[slot + 1] = self.starts, breaks + 1
        ends[slot], ends[head + (last - first)] = breaks, self.ends
        text[head], text[slot + 1] = docs, of
        return starts, ends, text

    def points(self) -> np.ndarray:
        """Code points before each byte place, in the buffer without its padding."""
        lead = (self.buf[: len(self.buf) - PAD] & 0xC0) != 0x80
        out = np.zeros(len(lead) + 1, np.int64)
        np.cumsum(lead, out=out[1:])
        return out

    def bytes_of(self, i: int) -> bytes:
        return self.buf[self.starts[i]:self.ends[i]].tobytes()


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """first[0]..last[0]-1, first[1]..last[1]-1 and so on."""
    sizes = last - first
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes - first, sizes)


ranges = _ranges


def trimmed(starts, ends, word_starts, word_ends):
    """Spans without the white space at both ends; a span without a word is empty."""
    if not len(word_starts):
        return starts, starts
    first = np.searchsorted(word_starts, starts)
    last = np.searchsorted(word_ends, ends, "right") - 1
    some = (first <= last) & (first < len(word_starts))
    first, last = np.where(some, first, 0), np.where(some, last, 0)
    begin = np.where(some, word_starts[first], starts)
    return begin, np.where(some, word_ends[last], begin)


def counted(column: np.ndarray) -> pa.Array:
    return pa.array(column.astype(np.int64), pa.int64())
