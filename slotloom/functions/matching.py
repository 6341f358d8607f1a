"""Matching within one row that array expressions cannot do in linear time: R5's queues, texts in texts, and E4's windows.

Both work on whole Arrow arrays. A texts-in-texts search builds an automaton over the row's needles once and passes each
of its texts through it, so its time follows the texts and the hits, not needles times texts.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# The functions below travel to the executors by value, so these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def greedy_flags(answers: list[str], options: list[list[str]]) -> list[bool]:
    """Which answers, in order, find an unused key with an equal option; each takes the first such key.

    Every option has a queue of its keys in order. A key that was used under another option is dropped when it comes to the
    front, so each entry of a queue is looked at once.
    """
    queues: dict[str, list[int]] = {}
    for key in range(len(options) - 1, -1, -1):  # the front of a queue is its end
        for name in options[key]:
            queues.setdefault(name, []).append(key)
    used, out = [False] * len(options), []
    for answer in answers:
        queue, found = queues.get(answer), False
        while queue:
            key = queue.pop()
            if not used[key]:
                used[key] = found = True
                break
        out.append(found)
    return out


def _offsets(lists: pa.ListArray) -> list[int]:
    return np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())]).tolist()


def _counted(slots: tuple[str, ...]):
    """Per record a struct for each slot: its name, and the numbers of matched answers, of answers and of keys."""
    def count(answer_slots: pa.Array, answers: pa.Array, key_slots: pa.Array, options: pa.Array) -> pa.Array:
        names, n, width = pa.array(slots), len(answers), len(slots)

        def placed(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            """(place among all records' slots, whether the slot is known) of each entry."""
            code = pc.index_in(lists.flatten(), value_set=names).fill_null(-1).to_numpy().astype(np.int64)
            row = np.repeat(np.arange(n), np.diff(_offsets(lists)))
            return row * width + code, code >= 0

        at, known = placed(answer_slots)
        key_at, key_known = placed(key_slots)
        texts, firsts = answers.flatten().to_pylist(), _offsets(answers)
        per_key = options.flatten()
        names_of, key_firsts, ends = per_key.flatten().to_pylist(), _offsets(options), _offsets(per_key)
        hit = np.zeros(len(texts), bool)
        for r in range(n):
            a, b, c, d = firsts[r], firsts[r + 1], key_firsts[r], key_firsts[r + 1]
            if a < b and c < d:
                hit[a:b] = greedy_flags(texts[a:b], [names_of[ends[k]:ends[k + 1]] for k in range(c, d)])
        sums = [np.bincount(x, minlength=n * width).astype(np.int64) for x in (at[hit & known], at[known], key_at[key_known])]
        each = pa.StructArray.from_arrays([pa.array(slots * n), *map(pa.array, sums)], ["slot", "correct", "generated", "gold"])
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), each)

    return count


TALLIES = "array<struct<slot:string,correct:long,generated:long,gold:long>>"


def tally_batches(slots: tuple[str, ...]):
    """For ``mapInArrow``: the last four columns, which :func:`_counted` takes, give way to the record's tallies.

    All arrays are in order. Answers and options begin with their slot, so that only those of one slot match.
    """
    count = _counted(slots)

    def run(batches):
        for batch in batches:
            kept = batch.num_columns - 4
            tallies = count(*(batch.column(i) for i in range(kept, kept + 4)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], tallies], [*batch.schema.names[:kept], "tallies"])

    return run


def hits(texts: list[str | None], needles: list[str | None]):
    """(text, needle) numbers of all pairs where the needle occurs in the text; an empty needle occurs in every text."""
    import ahocorasick

    places: dict[str, list[int]] = {}
    for i, needle in enumerate(needles):
        if needle is not None:
            places.setdefault(needle, []).append(i)
    everywhere = places.pop("", [])
    automaton = ahocorasick.Automaton()
    for needle, own in places.items():
        automaton.add_word(needle, own)
    automaton.make_automaton()
    known: dict[str, list[int]] = {}
    for o, text in enumerate(texts):
        if text is None:
            continue
        if text not in known:
            found = {own[0]: own for _, own in automaton.iter(text)} if places else {}
            known[text] = [i for own in found.values() for i in own] + everywhere
        for i in known[text]:
            yield o, i


def _contained(texts: pa.Array, needles: pa.Array) -> pa.Array:
    out = [[{"o": o, "i": i} for o, i in hits(t or [], n or [])] for t, n in zip(texts.to_pylist(), needles.to_pylist())]
    return pa.array(out, pa.list_(pa.struct([("o", pa.int32()), ("i", pa.int32())])))


def contained(texts: Column, needles: Column) -> Column:
    """Places (o, i) of all pairs of an array of texts and one of needles where the needle occurs in the text."""
    return F.arrow_udf(_contained, "array<struct<o:int,i:int>>")(texts, needles)


def nested(left: list[list[str]], right: list[list[str]]):
    """(left, right) numbers of all pairs of sets where one holds all of the other; an empty right set is in every left one.

    Tokens are ordered by how many sets of the other side hold them. A set is filed under its rarest token alone, as whoever
    contains it holds that one too, and only sets filed under a token of a set are compared with it.
    """
    sides = [set(x) for x in left], [set(x) for x in right]
    counts = []
    for side in sides:
        n: dict[str, int] = {}
        for tokens in side:
            for token in tokens:
                n[token] = n.get(token, 0) + 1
        counts.append(n)

    def filed(side: int) -> dict[str, list[int]]:
        out: dict[str, list[int]] = {}
        held = counts[1 - side]
        for i, tokens in enumerate(sides[side]):
            if tokens:
                rarest = min(tokens, key=lambda t: (held.get(t, 0), t))
                if rarest in held:  # else no set of the other side holds all of them
                    out.setdefault(rarest, []).append(i)
        return out

    by_right, by_left = filed(1), filed(0)
    empty = [j for j, tokens in enumerate(sides[1]) if not tokens]
    for i, tokens in enumerate(sides[0]):
        for j in empty:
            yield i, j
        for token in tokens:
            for j in by_right.get(token, ()):
                if sides[1][j] <= tokens:
                    yield i, j
    for j, tokens in enumerate(sides[1]):
        for token in tokens:
            for i in by_left.get(token, ()):
                if sides[0][i] < tokens:  # equal sets were found above
                    yield i, j


def _nested(left: pa.Array, right: pa.Array) -> pa.Array:
    out = [[{"o": o, "i": i} for o, i in nested(a or [], b or [])] for a, b in zip(left.to_pylist(), right.to_pylist())]
    return pa.array(out, pa.list_(pa.struct([("o", pa.int32()), ("i", pa.int32())])))


def nested_sets(left: Column, right: Column) -> Column:
    """Places (o, i) of all pairs of two arrays of token sets where one holds all of the other."""
    return F.arrow_udf(_nested, "array<struct<o:int,i:int>>")(left, right)


def occurrences(text: str, needles: list[str]) -> list[int]:
    """Non-overlapping occurrences of each needle from left to right; an empty one occurs between all characters."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for needle in needles:
        if needle:
            automaton.add_word(needle, needle)
    count, free = dict.fromkeys(needles, 0), dict.fromkeys(needles, 0)
    if len(automaton):
        automaton.make_automaton()
        for last, needle in automaton.iter(text):
            # hits of one needle come in order of their places
            if last + 1 - len(needle) >= free[needle]:
                count[needle] += 1
                free[needle] = last + 1
    if "" in count:
        count[""] = len(text) + 1
    return [count[n] for n in needles]


def _occurring(texts: pa.Array, needles: pa.Array) -> pa.Array:
    return pa.array([occurrences(t or "", n or []) for t, n in zip(texts.to_pylist(), needles.to_pylist())], pa.list_(pa.int32()))


def frequencies(text: Column, needles: Column) -> Column:
    """F1 for a document: the non-overlapping occurrences of each of an array of texts."""
    return F.arrow_udf(_occurring, "array<int>")(text, needles)


# Odd, so that it has an inverse modulo 2^64; any odd number with well mixed bits would do.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def window_hashes(words: np.ndarray, lengths: list[int]):
    """(length, hashes of all windows of that many words) for arrays of 64-bit word hashes.

    The hash of words w[0], w[1], ... is the sum of w[i] * base^i modulo 2^64. With the sums of all prefixes, the hash of any
    window is one difference, brought back to its start by a power of the base's inverse, whatever its length.
    """
    n = len(words)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words.astype(np.uint64) * _powers(_BASE, n), dtype=np.uint64)])
    back = _powers(_INVERSE, n)
    for length in lengths:
        if 0 < length <= n:
            yield length, (sums[length:] - sums[:-length]) * back[:n - length + 1]


def _windows(lengths: list[int], known: np.ndarray | None):
    kind = pa.list_(pa.struct([("tok_idx", pa.int32()), ("n_tok", pa.int32()), ("hash", pa.int64())]))

    def among(hashes: np.ndarray) -> np.ndarray:
        """Which hashes are known, in time that grows with the logarithm of the known ones."""
        if not len(known):
            return np.zeros(len(hashes), bool)
        return known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes

    def find(words: pa.Array) -> pa.Array:
        flat, ends = words.flatten().to_numpy(zero_copy_only=False).view(np.uint64), _offsets(words)
        sizes, parts = [0], []
        for low, high in zip(ends[:-1], ends[1:]):
            n = 0
            for length, hashes in window_hashes(flat[low:high], lengths):
                at = np.arange(len(hashes)) if known is None else np.flatnonzero(among(hashes))
                parts.append((at.astype(np.int32), np.full(len(at), length, np.int32), hashes[at].view(np.int64)))
                n += len(at)
            sizes.append(n)
        joined = [np.concatenate(x) for x in zip(*parts)] if parts else [np.empty(0, t) for t in (np.int32, np.int32, np.int64)]
        values = pa.StructArray.from_arrays([pa.array(x) for x in joined], ["tok_idx", "n_tok", "hash"])
        return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), values).cast(kind)

    return find


def windows(words: Column, lengths: list[int], known: list[int] | np.ndarray | None = None) -> Column:
    """All windows of the given numbers of words, ``(tok_idx, n_tok, hash)``; only those whose hash is in ``known``, if given.

    ``words`` is an array of 64-bit hashes.
    """
    wanted = None if known is None else np.unique(np.array(known, np.int64).view(np.uint64))
    return F.arrow_udf(_windows(lengths, wanted), "array<struct<tok_idx:int,n_tok:int,hash:bigint>>")(words)


def _whole(words: pa.Array) -> pa.Array:
    flat, ends = words.flatten().to_numpy(zero_copy_only=False).view(np.uint64), _offsets(words)
    found = [int(next(window_hashes(flat[a:b], [b - a]))[1][0]) if a < b else None for a, b in zip(ends[:-1], ends[1:])]
    return pa.array(found, pa.uint64()).view(pa.int64())


def window_hash(words: Column) -> Column:
    """The hash that :func:`windows` gives to a window of exactly these words; null for none."""
    return F.arrow_udf(_whole, "bigint")(words)


def block_vectors(
    unknown: list[float], singles: int, numbers: tuple[str, ...] = (), hots: tuple[tuple[str, tuple[str, ...]], ...] = (),
):
    """For ``cogroup().applyInArrow``: a block's rows with ``vectors``, by the block's own ``(word, vec)`` rows.

    A row's ``_words`` are those of its text and then ``singles`` words of their own; the text's vector, the mean over its words,
    comes first. A word without vector has that of ``unknown``. In front of all vectors stand the columns ``numbers`` and a 0/1
    entry for each value of the vocabularies of the columns ``hots``.
    """
    def fill(rows: pa.Table, found: pa.Table) -> pa.Table:
        n, width = found.num_rows, len(unknown)
        matrix = np.empty((n + 1, width))
        matrix[n] = unknown
        if n:
            matrix[:n] = found["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, width)
        words = rows["_words"].combine_chunks()
        at = pc.index_in(words.flatten(), value_set=found["word"].combine_chunks()).fill_null(n).to_numpy()
        ends = np.array(_offsets(words))
        firsts, lasts = ends[:-1], ends[1:] - singles
        own = at[np.arange(len(at)) < np.repeat(lasts, np.diff(ends))]
        starts = firsts - singles * np.arange(rows.num_rows)
        first = len(numbers) + sum(len(vocabulary) for _, vocabulary in hots)
        values = np.empty((rows.num_rows, first + (1 + singles) * width))
        values[:, :first] = 0
        lacking = np.zeros(values.shape, bool) if any(rows[c].null_count for c in numbers) else None
        for k, name in enumerate(numbers):
            column = rows[name].combine_chunks()
            values[:, k] = column.cast(pa.float64()).fill_null(0).to_numpy(zero_copy_only=False)
            if lacking is not None:
                lacking[:, k] = column.is_null().to_numpy(zero_copy_only=False)
        place = len(numbers)
        for name, vocabulary in hots:
            code = pc.index_in(rows[name].combine_chunks(), value_set=pa.array(vocabulary)).fill_null(-1).to_numpy()
            hit = np.flatnonzero(code >= 0)
            values[hit, place + code[hit]] = 1
            place += len(vocabulary)
        values[:, first:first + width] = np.add.reduceat(matrix[own], starts, axis=0) / (lasts - firsts)[:, None]
        for k in range(singles):
            values[:, first + (1 + k) * width:first + (2 + k) * width] = matrix[at[lasts + k]]
        places = np.arange(rows.num_rows + 1, dtype=np.int32) * values.shape[1]
        entries = pa.array(values.ravel(), mask=None if lacking is None else lacking.ravel())
        vectors = pa.ListArray.from_arrays(pa.array(places, pa.int32()), entries)
        return rows.drop_columns(["_block", "_words"]).append_column("vectors", vectors)

    return fill


def _weighted(lists: pa.Array) -> pa.Array:
    """Sums of numbers times their places from 1, each list's from left to right."""
    ends, sizes = np.array(_offsets(lists)), lists.value_lengths().fill_null(0).to_numpy()
    numbers = lists.flatten()
    flat = numbers.to_numpy(zero_copy_only=False)
    sums = np.zeros(len(lists))
    for size in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == size)
        for few in np.array_split(rows, -(-len(rows) * int(size) // (1 << 18))):  # of so many numbers at a time
            if ends[few[-1]] - ends[few[0]] == (len(few) - 1) * size:  # side by side
                given = flat[ends[few[0]]:ends[few[0]] + len(few) * size].reshape(-1, size)
            else:
                given = flat[ends[few][:, None] + np.arange(size)]
            sums[few] = np.cumsum(given * np.arange(1, size + 1), axis=1)[:, -1] + 0.0
    known = lists.is_valid().to_numpy(zero_copy_only=False).copy()
    if numbers.null_count:
        known[np.repeat(np.arange(len(lists)), sizes)[numbers.is_null().to_numpy(zero_copy_only=False)]] = False
    return pa.array(sums, mask=~known)


def weighted_sum(numbers: Column) -> Column:
    """The sum of an array's numbers times their places from 1; null for a null array or one that holds a null."""
    return F.arrow_udf(_weighted, "double")(numbers.cast("array<double>"))
