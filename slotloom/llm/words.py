"""Words and rolling hashes over the bytes of whole Arrow batches, without a Python object per word.

A word is a run of bytes other than 0x20 and 0x09-0x0D. All functions work on the concatenated
texts of a slice of rows; ``first`` says which words belong to which row, so a window that would
cross from one text into the next is never used. Hashes are 64 bits wide and depend on the words alone.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
# Longer words are hashed one by one.
LONG_WORD = 64
# Texts are taken in slices of about this many bytes, so that memory stays flat; a longer text is a slice.
SLICE_BYTES = 1 << 20
# Only some C libraries have it.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)

_WORD_STEP = np.uint64(0x9E3779B97F4A7C15)
_BYTE_CODES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit bijection that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Slice:
    """Rows ``low`` to ``high`` of a batch: their bytes and their words."""

    low: int
    high: int
    data: np.ndarray  # the bytes of all texts
    offsets: np.ndarray  # where each text starts in data, and the end
    starts: np.ndarray  # of each word
    ends: np.ndarray
    first: np.ndarray  # the first word of each text, and the end

    def hashes(self) -> np.ndarray:
        """A hash per word."""
        lengths = self.ends - self.starts
        order = np.argsort(-np.minimum(lengths, LONG_WORD + 1).astype(np.int16), kind="stable")
        starts, sizes = self.starts[order], lengths[order]
        many = np.bincount(np.minimum(sizes, LONG_WORD), minlength=LONG_WORD + 1)[::-1].cumsum()[::-1]
        value = np.full(len(starts), 0x51ED270B, dtype=np.uint64)
        for place in range(LONG_WORD):
            n = many[place + 1]
            if not n:
                break
            value[:n] = value[:n] * _WORD_STEP + _BYTE_CODES[self.data[starts[:n] + place]]
        for i in range(int(np.searchsorted(-sizes, -LONG_WORD, side="left"))):
            word = self.data[starts[i]:starts[i] + sizes[i]].tobytes()
            value[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        out = np.empty_like(value)
        out[order] = mix(value)
        return out

    def row_of_word(self) -> np.ndarray:
        """The row (from 0 within the slice) of each word."""
        return np.repeat(np.arange(self.high - self.low), np.diff(self.first))

    def room(self, size: int) -> np.ndarray:
        """Whether a window of so many words that starts at a word stays within its text."""
        left = np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self.starts))
        return left >= size

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()


def slices(texts: pa.Array, limit: int = SLICE_BYTES, blank: np.ndarray = SPACE) -> Iterator[Slice]:
    """The texts of an Arrow column, in order, in slices. A null is a text without words; ``blank`` says which bytes part words."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1)
        yield _split(low, high, data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low], blank)
        low = high
    give_back()


def give_back() -> None:
    """Return the memory that this worker has freed to the system: workers live on between stages, and their allocators keep it otherwise."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def _split(low: int, high: int, data: np.ndarray, offsets: np.ndarray, blank: np.ndarray) -> Slice:
    inked = ~blank[data]
    before = np.concatenate([[False], inked[:-1]]) if len(data) else inked.copy()
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after = np.concatenate([inked[1:], [False]]) if len(data) else inked.copy()
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inked & ~before)
    ends = np.flatnonzero(inked & ~after) + 1
    return Slice(low, high, data, offsets, starts, ends, np.searchsorted(starts, offsets))


def windows(hashes: np.ndarray, size: int, step: int) -> np.ndarray:
    """A hash of ``size`` consecutive values from each place; the last ``size - 1`` places hold no sense."""
    done, have, block, width = np.zeros(len(hashes), dtype=np.uint64), 0, hashes, 1
    power = step
    while True:
        if size & width:
            # what is done stands before this block
            done = done * np.uint64(power) + _shifted(block, have)
            have += width
        if have == size:
            return mix(done)
        block = block * np.uint64(power) + _shifted(block, width)
        width, power = width * 2, power * power & (1 << 64) - 1


def _shifted(values: np.ndarray, by: int) -> np.ndarray:
    if not by:
        return values
    out = np.zeros_like(values)
    out[:max(0, len(values) - by)] = values[by:]
    return out


def least(values: np.ndarray, size: int) -> np.ndarray:
    """The place of the smallest of ``size`` consecutive values from each place, the first of equals."""
    best, places, width = values, np.arange(len(values)), 1
    top = np.uint64(0xFFFFFFFFFFFFFFFF)

    def joined(by: int):
        other = np.full_like(best, top)
        other[:max(0, len(best) - by)] = best[by:]
        where = np.zeros_like(places)
        where[:max(0, len(best) - by)] = places[by:]
        later = other < best
        return np.where(later, other, best), np.where(later, where, places)

    while width * 2 <= size:
        best, places = joined(width)
        width *= 2
    if width < size:
        best, places = joined(size - width)
    return places
