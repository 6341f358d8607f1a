"""Token ids of whole texts by the tokenizers library, each distinct run of characters encoded once.

Only for tokenizers that drop white space and lower case, so that a text's ids are those of its words, one after
another (``word_bpe_49k.json``). That tokenizer also cuts words between letters, digits and other signs; where both
sides of such a cut are plain ASCII, words are cut there beforehand and put in lower case, which leaves far fewer
distinct runs. Runs of a slice of texts are told apart by 64-bit hashes; new ones go to the library in batches and stay in
a bounded memory of the worker.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from slotloom.llm.words import Slice, slices

# Distinct runs that a worker remembers; beyond, it starts anew.
REMEMBERED = 1_500_000
BATCH = 4096
# A slice's ids take several times its bytes.
SLICE_BYTES = 2 << 20

# Kinds of bytes: letter, digit, sign; 0 for all that is not cut (white space does not occur within words).
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[48:58] = 2
_KIND[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "'<>|"]] = 3
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def default_path(name: str = "word_bpe_49k.json") -> str:
    """The place of a public tokenizer's file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Memory:
    """Ids by hash: sorted arrays, new entries apart until they are many."""

    def __init__(self, most: int = REMEMBERED):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.runs = [(np.zeros(0, np.uint64), np.zeros(0, np.int64)) for _ in range(2)]
        self.sizes, self.begins, self.flags = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.uint8)
        self.flat, self.used = np.zeros(0, np.uint32), 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The entry of each key, or -1."""
        out = np.full(len(keys), -1, np.int64)
        for known, entry in self.runs:
            if len(known):
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                hit = known[at] == keys
                out[hit] = entry[at[hit]]
        return out

    def add(self, keys: np.ndarray, ids: list[list[int]], flags: np.ndarray | None = None) -> None:
        sizes = np.fromiter(map(len, ids), np.int32, len(ids))
        total = int(sizes.sum())
        if self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat[:self.used], np.zeros(max(total, self.used // 2) + 1024, np.uint32)])
        self.flat[self.used:self.used + total] = np.fromiter((i for x in ids for i in x), np.uint32, total)
        entry = len(self.sizes) + np.arange(len(keys))
        self.begins = np.concatenate([self.begins, self.used + np.cumsum(sizes, dtype=np.int64) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flags = np.concatenate([self.flags, np.zeros(len(keys), np.uint8) if flags is None else flags.astype(np.uint8)])
        self.used += total
        self._merge(1, keys, entry)
        if len(self.runs[1][0]) > 4096 + len(self.runs[0][0]) // 4:
            self._merge(0, *self.runs[1])
            self.runs[1] = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def _merge(self, run: int, keys: np.ndarray, entry: np.ndarray) -> None:
        keys, entry = np.concatenate([self.runs[run][0], keys]), np.concatenate([self.runs[run][1], entry])
        order = np.argsort(keys, kind="stable")
        self.runs[run] = keys[order], entry[order]

    def gather(self, part: Slice, learn) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, offsets per text, flags per run) of a slice cut into runs; ``learn(runs)`` gives ids and flags of new ones."""
        keys, first, which = np.unique(part.hashes(), return_index=True, return_inverse=True)
        at = self.find(keys)
        new = np.flatnonzero(at < 0)
        if len(self.sizes) + len(new) > self.most:
            self.clear()
            new = np.arange(len(keys))
        for low in range(0, len(new), BATCH):
            some = new[low:low + BATCH]
            self.add(keys[some], *learn([part.word(i).decode("utf-8", "replace") for i in first[some].tolist()]))
        at = self.find(keys)[which]
        sizes = self.sizes[at]
        ends = np.cumsum(sizes, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.arange(total) + np.repeat(self.begins[at] - (ends - sizes), sizes)]
        return ids, np.concatenate([[0], ends])[part.first], self.flags[at]


def runs(part: Slice) -> Slice:
    """The words of a slice in lower case, cut between plain letters, digits and signs."""
    data = _LOWER[part.data]
    if (part.data == 0x3C).any():  # what may be a special token stays as it is
        for i in np.unique(np.searchsorted(part.starts, np.flatnonzero(part.data == 0x3C), "right") - 1).tolist():
            data[part.starts[i]:part.ends[i]] = part.data[part.starts[i]:part.ends[i]]
    kind = _KIND[data]
    cuts = np.flatnonzero((kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)) + 1
    cuts = np.setdiff1d(cuts, part.offsets, assume_unique=False)  # texts lie side by side
    starts, ends = np.sort(np.concatenate([part.starts, cuts])), np.sort(np.concatenate([part.ends, cuts]))
    return Slice(part.low, part.high, data, part.offsets, starts, ends, np.searchsorted(starts, part.offsets))


class Encoder:
    """Ids for slices of texts."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path if os.path.exists(path) else default_path(os.path.basename(path)))
        self.memory = Memory()

    def encode(self, part: Slice) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the slice, and where each text's ids start (and the end)."""
        def learn(texts: list[str]):
            return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)], None

        ids, offsets, _ = self.memory.gather(runs(part), learn)
        return ids, offsets


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a worker per core
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode_texts(encoder: Encoder, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(low, high, ids, offsets) for each slice of a column of texts; a null has no ids."""
    for part in slices(texts, SLICE_BYTES):
        ids, offsets = encoder.encode(part)
        yield part.low, part.high, ids, offsets


def with_end(ids: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Every text's ids with ``end`` behind them."""
    n = len(offsets) - 1
    out = np.insert(ids, offsets[1:], np.full(n, end, ids.dtype))
    return out, offsets + np.arange(n + 1)
