"""Best-fit packing by bin completion, over the counts of lengths.

How pieces fill sequences depends on their lengths alone, and there are at most ``capacity`` of these. So
Spark counts the lengths, the search packs *counts* into patterns (a multiset of lengths, used so many
times), and Spark hands the places of the patterns out to the pieces by their rank among equals.
What the driver sees is bounded by the capacity at any size of the input.

The search takes the largest piece left and enumerates undominated fillings of the rest of its
sequence: largest pieces first, a filling being dominated if a free piece could replace one or two of its
pieces without overflow and with less waste. The best-fit filling is the first incumbent; a
branch ends when it can't beat it, or when the waste so far plus its own exceeds what a better solution may
waste. A filling is applied as often as the counts allow. Packings by best-fit decreasing and by the first
descent are kept as incumbents; the search goes on from alternative fillings until the lower bound is met or
``NODES`` nodes are spent, and then returns the best packing found, which always holds every piece.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotloom.llm import tokens
from slotloom.session import stage

CAPACITY = 2048
# Search effort: nodes of the whole search, nodes and fillings for one sequence.
NODES = 6_000
FILL_NODES = 2_000
FILLS = 3
# About so many pieces of one length are ranked together.
RANKED = 100_000

Pattern = tuple[int, tuple[int, ...]]


def lower_bound(counts: np.ndarray) -> int:
    """Sequences needed at least: by total length, and by pieces too long to share (for every cut)."""
    capacity = len(counts) - 1
    sizes = np.arange(capacity + 1)
    best = -(-int((counts * sizes).sum()) // capacity)
    number, total = np.cumsum(counts), np.cumsum(counts * sizes)
    for cut in range(capacity // 2 + 1):
        # pieces over capacity - cut stand alone; those over half can't pair; pieces from cut on may fill
        big = int(number[capacity] - number[capacity - cut])
        half_lo = capacity // 2
        middle = int(number[capacity - cut] - number[half_lo]) if capacity - cut > half_lo else 0
        middle_sum = int(total[capacity - cut] - total[half_lo]) if capacity - cut > half_lo else 0
        small_sum = int(total[half_lo] - (total[cut - 1] if cut else 0))
        best = max(best, big + middle + max(0, -(-(small_sum - (middle * capacity - middle_sum)) // capacity)))
    return best


def best_fit(counts: np.ndarray) -> list[Pattern]:
    """Best-fit decreasing, a pattern at a time: the largest piece left, then again and again the largest that fits."""
    return [(n, fill) for n, fill, _ in _descend(counts.copy(), lambda largest, left: [_greedy(left, len(left) - 1 - largest)])]


def _greedy(left: np.ndarray, gap: int) -> tuple[int, ...]:
    taken, free = [], left.copy()
    while gap > 0:
        some = np.flatnonzero(free[1:gap + 1])
        if not len(some):
            break
        size = int(some[-1]) + 1
        taken.append(size)
        free[size] -= 1
        gap -= size
    return tuple(taken)


def _times(left: np.ndarray, fill: tuple[int, ...]) -> int:
    sizes, uses = np.unique(fill, return_counts=True)
    return int((left[sizes] // uses).min())


def _descend(left: np.ndarray, fillings):
    capacity = len(left) - 1
    while left.any():
        largest = int(np.flatnonzero(left)[-1])
        left[largest] -= 1
        fill = (largest, *fillings(largest, left)[0])
        left[largest] += 1
        n = _times(left, fill)
        np.subtract.at(left, list(fill), n)
        yield n, fill, n * (capacity - sum(fill))


def _dominated(fill: list[int], slack: int, left: list[int], present: list[int], used: dict[int, int]) -> bool:
    """``present[x]`` is the number of lengths up to x that are left before the filling takes its own."""
    if not slack:
        return False
    spent = [x for x, n in used.items() if n >= left[x]]

    def free(low: int, high: int) -> bool:
        return present[high] - present[low - 1] > sum(low <= x <= high for x in spent)

    if any(free(x + 1, x + slack) for x in set(fill)):
        return True
    return any(free(x + 1, x + slack) for x in {a + b for i, a in enumerate(fill) for b in fill[i + 1:]})


def fillings(gap: int, left: np.ndarray, allowed: int) -> list[tuple[int, ...]]:
    """Undominated fillings of ``gap``, least waste first; at most ``FILLS``, and the best-fit one if none is better."""
    sizes = (np.flatnonzero(left[1:gap + 1]) + 1)[::-1]
    # where the sizes begin that fit into each room
    begin = np.searchsorted(-sizes, -np.arange(gap + 1)).tolist()
    sizes = sizes.tolist()
    counts, present = left.tolist(), np.cumsum(left > 0).tolist()
    first = _greedy(left, gap)
    found = [(gap - sum(first), first)]
    budget = FILL_NODES

    def search(at: int, room: int, fill: list[int], used: dict[int, int]) -> None:
        nonlocal budget
        budget -= 1
        if budget < 0 or found[0][0] == 0:
            return
        extended = False
        for i in range(max(at, begin[room]), len(sizes)):
            size = sizes[i]
            if used.get(size, 0) >= counts[size]:
                continue
            extended = True
            used[size] = used.get(size, 0) + 1
            fill.append(size)
            search(i, room - size, fill, used)
            fill.pop()
            used[size] -= 1
            if not used[size]:
                del used[size]
            if budget < 0 or found[0][0] == 0:
                return
        bound = min(allowed, found[-1][0] - 1 if len(found) >= FILLS else gap)
        if not extended and room <= bound and tuple(fill) != first and not _dominated(fill, room, counts, present, used):
            found.append((room, tuple(fill)))
            found.sort(key=lambda x: x[0])
            del found[FILLS:]

    if found[0][0]:
        search(0, gap, [], {})
    return [f for _, f in found]


def complete(counts: np.ndarray, nodes: int = NODES) -> list[Pattern]:
    """Patterns that hold every piece; ``counts[n]`` is the number of pieces of length n (1 to capacity)."""
    capacity = len(counts) - 1
    total = int((counts * np.arange(capacity + 1)).sum())
    bound = lower_bound(counts)
    best = best_fit(counts)
    size = sum(n for n, _ in best)
    left = counts.copy()
    spent = 0
    # Depth first without recursion: each level holds the fillings still to try there.
    path: list[tuple[Pattern, list[tuple[int, ...]]]] = []
    waste = 0

    def put(level: list[tuple[int, ...]], largest: int) -> None:
        nonlocal waste
        fill = (largest, *level.pop(0))
        n = _times(left, fill)
        np.subtract.at(left, list(fill), n)
        waste += n * (capacity - sum(fill))
        path.append(((n, fill), level))

    while size > bound:
        allowed = (size - 1) * capacity - total - waste
        if allowed >= 0 and left.any() and spent < nodes:
            largest = int(np.flatnonzero(left)[-1])
            left[largest] -= 1
            level = fillings(capacity - largest, left, allowed)
            left[largest] += 1
            spent += 1
            put(level, largest)
            continue
        if allowed >= 0 and not left.any():
            best, size = [p for p, _ in path], sum(p[0] for p, _ in path)
        if spent >= nodes:
            break
        while path:
            (n, fill), level = path.pop()
            np.add.at(left, list(fill), n)
            waste -= n * (capacity - sum(fill))
            if level:
                spent += 1
                put(level, fill[0])
                break
        else:
            break
    return best


def places(patterns: list[Pattern]) -> pd.DataFrame:
    """Where the pieces of each length go: ranks from ``rank`` on, ``uses`` a sequence from ``sequence`` on, at ``offset``."""
    out, ranks, sequence = [], {}, 0
    for n, fill in patterns:
        offset = 0
        for size in sorted(set(fill), reverse=True):
            uses = fill.count(size)
            out.append((size, ranks.get(size, 0), uses, sequence, offset))
            ranks[size] = ranks.get(size, 0) + n * uses
            offset += uses * size
        sequence += n
    return pd.DataFrame(out, columns=["length", "rank", "uses", "sequence", "offset"]).sort_values(["length", "rank"], ignore_index=True)


def pieces(docs: DataFrame, text: str, path: str, end: int, capacity: int) -> DataFrame:
    """row, piece, start, length, ids_crc32: every document's ids and ``end``, cut where they exceed the capacity."""
    def cut(batches):
        encoder = tokens.encoder(path)
        for batch in batches:
            rows = batch.column("row")
            for low, high, ids, offsets in tokens.encode_texts(encoder, pc.struct_field(rows, text)):
                ids, offsets = tokens.with_end(ids, offsets, end)
                sizes = np.diff(offsets)
                many = -(-sizes // capacity)
                row = np.repeat(np.arange(low, high), many)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                start = piece * capacity
                length = np.minimum(np.repeat(sizes, many) - start, capacity)
                begin = np.repeat(offsets[:-1], many) + start
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a:4 * (a + n)]) for a, n in zip(begin.tolist(), length.tolist())]
                slim = kept.take(pa.array(row)) if (kept := _without(rows, text)) is not None else None
                yield pa.RecordBatch.from_arrays(
                    [slim, pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                    ["row", "piece", "start", "length", "ids_crc32"])

    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    # a struct must not be empty
    rows = docs.select(F.struct(*others, F.col(f"`{text}`").cast("string").alias(text)).alias("row"))
    slim = docs.select(F.struct(*others).alias("row")) if others else docs.select(F.struct(F.lit(0).alias("_")).alias("row"))
    kind = slim.schema["row"].dataType.simpleString()
    return rows.mapInArrow(cut, f"row {kind}, piece int, start long, length long, ids_crc32 long")


def _without(rows: pa.StructArray, text: str) -> pa.Array:
    names = [f.name for f in rows.type if f.name != text]
    if not names:
        return pa.StructArray.from_arrays([pa.array(np.zeros(len(rows), np.int32))], ["_"])
    return pa.StructArray.from_arrays([pc.struct_field(rows, n) for n in names], fields=[rows.type.field(n) for n in names])


def pack(docs: DataFrame, text: str = "text", path: str = "word_bpe_49k.json", end: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """All documents in as few sequences of ``capacity`` tokens as the search finds.

    Returns a row per piece: row (a struct of the document's columns but the text), piece, start, length,
    ids_crc32, sequence_id, offset. A null or empty text is the end id alone. Repeated rows are packed each; equal
    lengths are interchangeable, so ties are broken by hash. ``path`` names a tokenizer file, looked up on
    each executor. No row gives no rows.
    """
    cut = stage(pieces(docs, text, path, end, capacity), "pieces")
    table = cut.groupBy("length").agg(F.count("*").alias("n")).toPandas()  # at most a row per length
    counts = np.zeros(capacity + 1, dtype=np.int64)
    counts[table["length"].to_numpy(dtype=np.int64)] = table["n"].to_numpy(dtype=np.int64)
    plan = places(complete(counts))
    lengths, ranks = plan["length"].to_numpy(np.int64), plan["rank"].to_numpy(np.int64)
    rest = plan[["uses", "sequence", "offset"]].to_numpy(np.int64).reshape(-1, 3)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        wide = 1 << 40
        at = np.searchsorted(lengths * wide + ranks, length.to_numpy(np.int64) * wide + rank.to_numpy(np.int64), "right") - 1
        k, uses = rank.to_numpy(np.int64) - ranks[at], rest[at, 0]
        return pd.DataFrame({"sequence_id": rest[at, 1] + k // uses, "offset": rest[at, 2] + k % uses * length.to_numpy(np.int64)})

    most = int(counts.max()) if len(counts) else 0
    salted = cut.withColumn("_salt", F.pmod(F.xxhash64("ids_crc32", "piece", *_hashable(cut)), F.lit(max(8, -(-most // RANKED)))))
    before = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n")).withColumn(
        "_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("_n")).drop("_n")
    ranked = salted.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_salt").orderBy("ids_crc32", "piece")) - 1)
    return ranked.join(before, ["length", "_salt"]).withColumn("_place", place("length", F.col("_rank") + F.col("_before"))).select(
        "row", "piece", "start", "length", "ids_crc32", "_place.sequence_id", "_place.offset")


def _hashable(df: DataFrame) -> list[str]:
    return [] if any(k in df.schema["row"].dataType.simpleString() for k in ("map<", "variant")) else ["row"]
