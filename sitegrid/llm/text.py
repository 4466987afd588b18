"""Vectorised text helpers for Arrow batches: blocks, words, hashes, ragged arrays.

A batch of texts is cut into blocks of whole texts of about `BLOCK` bytes, so that a
worker's memory follows the longest text and not the batch. Null texts count as empty.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
U64 = np.uint64

#: bytes that separate words: space and the five controls from tab to carriage return
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Block:
    """Rows `start` to `stop` of a batch: their UTF-8 bytes and where each text begins."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, start: int):
        self.data, self.offsets, self.start = data, offsets, start
        self.n = len(offsets) - 1
        self.stop = start + self.n

    def text_of(self, at: np.ndarray) -> np.ndarray:
        """Index of the text that holds each byte position."""
        return np.searchsorted(self.offsets, at, "right") - 1


def blocks(texts: pa.Array, size: int = BLOCK) -> Iterator[Block]:
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, texts.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    start = 0
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
        stop = min(max(stop, start + 1), n)
        yield Block(data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start], start)
        start = stop


def spans(block: Block, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of `inside` bytes that stay in one text: starts, ends, first run of each text."""
    before = np.zeros(len(inside), bool)
    before[1:] = inside[:-1]
    edges = block.offsets[:-1]
    before[edges[edges < len(inside)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(inside), bool)
    after[:-1] = inside[1:]
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, block.offsets)


def words(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words `[^\\x20\\x09-\\x0D]+`: starts, ends, and the first word of each text."""
    return spans(block, ~SEPARATOR[block.data])


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


class Hasher:
    """Polynomial hashes of byte ranges through prefix sums, modulo 2**64, then mixed.

    Each byte stands for a random 64-bit number; `seed` gives independent hashes.
    """

    def __init__(self, seed: int = 1, lower: bool = False):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.letters = rng.integers(0, 2**64, 256, np.uint64) | U64(1)
        if lower:
            self.letters = self.letters[LOWER]
        base = int(rng.integers(0, 2**63)) * 8 + 5
        self.base, self.inverse = base % 2**64, pow(base, -1, 2**64)
        self._size = 0

    def __getstate__(self):
        return {"letters": self.letters, "base": self.base, "inverse": self.inverse, "_size": 0}

    def _powers(self, n: int) -> None:
        if n <= self._size:
            return
        for name, base in (("up", self.base), ("down", self.inverse)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            setattr(self, name, np.multiply.accumulate(p))
        self._size = n

    def ranges(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of data[s:e] for ascending, disjoint or equally long ranges."""
        out = np.empty(len(starts), np.uint64)
        at = 0
        while at < len(starts):  # pieces of bounded size, also inside a very long text
            low = int(starts[at])
            to = max(int(np.searchsorted(ends, low + BLOCK, "right")), at + 1)
            s, e = starts[at:to] - low, ends[at:to] - low
            size = int(e[-1])
            self._powers(size + 1)
            sums = np.zeros(size + 1, np.uint64)
            np.cumsum(self.letters[data[low : low + size]] * self.up[:size], out=sums[1:])
            out[at:to] = (sums[e] - sums[s]) * self.down[s] + (e - s).astype(np.uint64)
            at = to
        return mix(out)


def ngrams(h: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Order-sensitive hash of every n consecutive hashes; neighbours may span texts."""
    size = len(h) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    acc = np.full(size, 0x9E3779B97F4A7C15 + 2 * seed, np.uint64)
    for k in range(n):
        acc *= U64(0xD6E8FEB86659FD93 + 4 * seed)
        acc += h[k : k + size]
    return mix(acc)


def starts_of(first: np.ndarray, n: int) -> np.ndarray:
    """Positions where n consecutive elements stay in one text. first: the first element of each text, and the end."""
    size = int(first[-1])
    left = np.repeat(first[1:], np.diff(first)) - np.arange(size)
    return np.flatnonzero(left >= n)


def owners(first: np.ndarray) -> np.ndarray:
    """Index of the text each element belongs to."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ranges values[s:s+l], one after another."""
    total = int(lengths.sum())
    if not total:
        return values[:0]
    shift = starts - (np.cumsum(lengths) - lengths)
    return values[np.repeat(shift, lengths) + np.arange(total)]


def sums_by(first: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of the values of each text; zero for texts without any."""
    total = np.zeros(len(values) + 1, np.result_type(values.dtype, np.int64))
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def sliding(h: np.ndarray, n: int, best) -> np.ndarray:
    """best (np.minimum or np.maximum) of every n consecutive values."""
    width, out = 1, h
    while 2 * width <= n:
        out = best(out[:-width], out[width:]) if len(out) > width else out[:0]
        width *= 2
    if width < n:
        rest = n - width
        out = best(out[:-rest], out[rest:]) if len(out) > rest else out[:0]
    return out


def anchors(h: np.ndarray, first: np.ndarray, base: int, target: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smallest base window of each target window.

    h: hashes of base windows at every element position, `first`: elements of each
    text. Returns target window starts, the smallest hash in each, and the positions
    of base windows that are the smallest of some target window. Equal target windows
    have equal smallest base windows at equal places.
    """
    at = starts_of(first, target)
    if not len(at):
        return at, h[:0], at
    low = sliding(h, target - base + 1, np.minimum)[at]
    chosen = np.zeros(len(h), bool)
    edge = np.zeros(len(h) + target, np.uint64)  # largest of the minima of the windows around a position
    edge[at + target - base] = low
    top = sliding(edge, target - base + 1, np.maximum)[: len(h)]
    chosen = (top == h) & (top > 0)
    return at, low, np.flatnonzero(chosen)


def strings(data: np.ndarray, lengths: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """Texts (or binaries) of the given lengths that lie one after another in data."""
    kind = kind or pa.string()
    offsets = np.append(0, np.cumsum(lengths)).astype(np.int32)
    return pa.Array.from_buffers(kind, len(lengths), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(data).tobytes())])


def lists(column: pa.Array, start: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Flat values of rows start..start+n of a list column, and the first value of each row; null lists are empty."""
    part = column.slice(start, n)
    sizes = np.array([0 if s is None else s for s in pc.list_value_length(part).to_pylist()], np.int64)
    return part.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(sizes))


def listed(h: np.ndarray, owner: np.ndarray, values: np.ndarray, until: np.ndarray) -> np.ndarray:
    """Which hashes are in the list of their text."""
    if not len(values) or not len(h):
        return np.zeros(len(h), bool)
    salt = U64(0x9E3779B97F4A7C15)
    there = pd.Index(np.unique(mix(values.view(np.uint64) + owners(until).astype(np.uint64) * salt)))
    return there.get_indexer(mix(h + owner.astype(np.uint64) * salt)) >= 0


def released(run):
    """`run` for mapInArrow, giving memory back when a task ends: workers live on, and their free memory counts."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library keeps its own house
                pass

    return wrapped
