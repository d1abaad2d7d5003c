"""Words of Arrow text columns as arrays: places, 64-bit names and hashes of word windows.

A batch of texts is one byte buffer, so splitting and naming words are a few passes over it
instead of a loop over words. Texts are read as UTF-8 bytes; the three word patterns in use
only tell ASCII bytes apart, so bytes and characters give the same words.

Names are 64-bit hashes of the whole word (mixed polynomials modulo 2^64). Among n different
words or windows the chance of any clash is about n^2 / 2^65.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text handled at once. Power tables and scratch arrays take some 60 bytes for each.
CHUNK_BYTES = 500_000

_BASE = 0x9E3779B97F4A7C15
_MULTIPLIER = 0xD1342543DE82EF95
_MASK = (1 << 64) - 1

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _table(*separators: range) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    for span in separators:
        table[list(span)] = False
    return table


# Words are runs of the other bytes.
SPACE_SEPARATED = _table(range(0x09, 0x0E), range(0x20, 0x21))
ALPHANUMERIC = _table(range(0x00, 0x30), range(0x3A, 0x61), range(0x7B, 0x80))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def spread(n: int, seed: int = 0) -> np.ndarray:
    """``n`` fixed 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed * 0x632BE59BD9B4E019 & _MASK))


_BYTES = spread(256)
_powers = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2^64; tables grow by doubling and are kept."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        held = np.full(size, base, dtype=np.uint64)
        held[0] = 1
        held = np.cumprod(held, dtype=np.uint64)
        if n <= 2 * CHUNK_BYTES:
            _powers[base] = held
    return held[:n]


def window_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _MULTIPLIER) -> np.ndarray:
    """Mixed polynomial hash of ``values[start:end]`` for each pair; equal slices, equal hash."""
    n = len(values)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * powers(base, max(n, 1))[:n], dtype=np.uint64, out=sums[1:])
    out = sums[ends] - sums[starts]
    out *= powers(pow(base, -1, 1 << 64), n + 1)[starts]
    return mix(out)


class Words(NamedTuple):
    """Words of some texts, one after the other."""

    data: np.ndarray  # bytes, lower case where asked for
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # byte after each word
    first: np.ndarray  # number of the first word of each text, and the number of all words
    name: np.ndarray  # 64-bit name of each word

    def text_of(self) -> np.ndarray:
        """The text (by number) that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offset of each; a null text counts as an empty one."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.empty(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None:
        return np.empty(0, dtype=np.uint8), offsets - offsets[0]
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, column: str, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text each, whole texts only."""
    _, offsets = utf8(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def gathered(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Batches of about ``size`` bytes of text, made of the slices of smaller or larger ones."""
    held, total = [], 0
    for batch in batches:
        for part in chunks(batch, column, size):
            held.append(part)
            total += part.column(column).nbytes
            if total >= size:
                yield _joined(held)
                held, total = [], 0
    if held:
        yield _joined(held)
        held = []
    give_back()


def give_back() -> None:
    """Return freed memory to the system: workers stay for the next step, beside those of other steps."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(parts) == 1:
        return parts[0]
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def split(texts: pa.Array, is_word: np.ndarray, lower: bool, names: bool = True) -> Words:
    """Words of each text; ``lower`` turns A-Z to a-z first.

    The bytes are gone through in pieces of about ``CHUNK_BYTES``, which bounds the scratch
    memory; a longer text is cut between words.
    """
    raw, offsets = utf8(texts)
    data = LOWER[raw] if lower else raw
    edges = np.unique(offsets)
    if len(data) <= CHUNK_BYTES:
        start, end, name = _split(data, edges, is_word, names)
    else:
        edges = np.unique(np.concatenate((edges, _cuts(data, edges, is_word))))
        parts, at = [], 0
        while at < len(edges) - 1:
            to = int(np.searchsorted(edges, edges[at] + CHUNK_BYTES, side="right")) - 1
            to = max(to, at + 1)
            base = edges[at]
            start, end, name = _split(data[base : edges[to]], edges[at : to + 1] - base, is_word, names)
            parts.append((start + base, end + base, name))
            at = to
        start, end, name = (np.concatenate(x) for x in zip(*parts))
    return Words(data, start, end, np.searchsorted(start, offsets), name)


def _cuts(data: np.ndarray, edges: np.ndarray, is_word: np.ndarray) -> np.ndarray:
    """Places between words that cut what is longer than a piece."""
    cuts = []
    for i in np.flatnonzero(np.diff(edges) > CHUNK_BYTES).tolist():
        at = int(edges[i]) + CHUNK_BYTES
        while at < edges[i + 1]:
            # Words are short, so the next gap is near; a word without one is a piece of its own.
            for reach in (256, 1 << 16, int(edges[i + 1]) - at):
                gap = np.flatnonzero(~is_word[data[at : min(at + reach, edges[i + 1])]])
                if len(gap):
                    break
            if not len(gap):
                break
            cuts.append(at + int(gap[0]))
            at = cuts[-1] + CHUNK_BYTES
    return np.array(cuts, dtype=np.int64)


def _split(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, names: bool):
    n = len(data)
    inside = is_word[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < n]
    begins[edges] = inside[edges]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    edges = edges[edges > 0] - 1
    closes[edges] = inside[edges]
    start, end = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    name = window_sums(_BYTES[data], start, end, _BASE) if names else np.empty(0, dtype=np.uint64)
    return start, end, name


def shingles(name: np.ndarray, k: int) -> np.ndarray:
    """Name of each run of ``k`` words; the caller leaves out runs that cross texts."""
    n = max(len(name) - k + 1, 0)
    out = np.zeros(n, dtype=np.uint64)
    for i, factor in enumerate(spread(k, seed=k) | np.uint64(1)):
        out += name[i : n + i] * factor
    return mix(out)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted different values; ``np.unique`` builds a hash table, in many times the time and memory."""
    values = np.sort(values)
    fresh = np.ones(len(values), dtype=bool)
    fresh[1:] = values[1:] != values[:-1]
    return values[fresh]


def unique_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different pairs of two arrays of non-negative numbers, ordered."""
    if not len(a):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    width = int(b.max()) + 1
    both = np.unique(a.astype(np.int64) * width + b)
    return both // width, both % width


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``start, start + 1, ..`` for each start, ``count`` numbers each, one after the other."""
    total = int(counts.sum())
    return np.arange(total) + np.repeat(starts - (np.cumsum(counts) - counts), counts)
