"""Packed id matrices: best-fit decreasing with a segment tree over capacities, written and read back.

Documents become token ids with an end id behind them; documents longer than a sequence are split
into pieces without loss. Pieces go to packing groups by hash. A group holds a bounded number of tokens, so
each is packed in one task, longest pieces first. A segment tree over the room left (leaves 0 to
``length``) finds, in logarithmic steps, the open sequence with the least room that still takes the piece.

A written row is one sequence: ``ids`` (``length`` little-endian ids of 2 or 4 bytes, filled up with ``pad``),
``cu_seqlens`` (0, and the end of each segment), ``resets`` (where positions start again from 0), and
``segments`` (document, piece, and where the piece starts in its document).

Defined results: a null or empty text is the end id alone; repeated rows are packed each; an empty table
writes no sequence.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotloom.llm import tokens
from slotloom.session import scratch_path

LENGTH = 2048
# About so many bytes of text make a packing group.
GROUP_BYTES = 4 << 20


class Rooms:
    """Open sequences by the room they have left; ``take`` finds the tightest that fits."""

    def __init__(self, most: int):
        self.width = 1
        while self.width < most + 1:
            self.width *= 2
        self.tree = [0] * (2 * self.width)
        self.open: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, sequence: int, room: int) -> None:
        self.open[room].append(sequence)
        at = room + self.width
        while at:
            self.tree[at] += 1
            at //= 2

    def take(self, size: int) -> tuple[int, int] | None:
        """(sequence, its room) of the least room of ``size`` or more."""
        at, tree = size + self.width, self.tree
        if not tree[at]:
            # up to the first subtree on the right that holds something, then down its left edge
            while at > 1 and (at % 2 or not tree[at + 1]):
                at //= 2
            if at <= 1:
                return None
            at += 1
            while at < self.width:
                at = 2 * at if tree[2 * at] else 2 * at + 1
        room = at - self.width
        sequence = self.open[room].pop()
        while at:
            tree[at] -= 1
            at //= 2
        return sequence, room


def best_fit_decreasing(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Which pieces each sequence holds; equal pieces in the given order."""
    rooms, out = Rooms(length), []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        found = rooms.take(size)
        if found is None:
            found = len(out), length
            out.append([])
        out[found[0]].append(i)
        rooms.put(found[0], found[1] - size)
    return out


def _kind(width: int) -> str:
    return "<u2" if width == 2 else "<u4"


def _cut(path: str, end: int, length: int, width: int):
    def cut(batches):
        encoder = tokens.encoder(path)
        for batch in batches:
            group, doc = batch.column("group"), batch.column("doc")
            for low, high, ids, offsets in tokens.encode_texts(encoder, batch.column("text")):
                ids, offsets = tokens.with_end(ids, offsets, end)
                if len(ids) and int(ids.max()) >= 1 << 8 * width:
                    raise ValueError(f"an id does not fit {width} bytes")
                many = -(-np.diff(offsets) // length)
                row = np.repeat(np.arange(low, high), many)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                begin = np.repeat(offsets[:-1], many) + piece * length
                stop = np.minimum(begin + length, np.repeat(offsets[1:], many))
                raw = ids.astype(_kind(width)).tobytes()
                data = pa.array([raw[width * a:width * b] for a, b in zip(begin.tolist(), stop.tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [group.take(pa.array(row)), doc.take(pa.array(row)), pa.array(piece, pa.int32()), data],
                    ["group", "doc", "piece", "ids"])
    return cut


def _fill(length: int, width: int, pad: int):
    def fill(table: pa.Table) -> pa.Table:
        data = table.column("ids").combine_chunks()
        sizes = pc.binary_length(data).to_numpy() // width
        raw, pieces, docs = data.to_pylist(), table.column("piece").to_pylist(), table.column("doc").to_pylist()
        empty = np.full(length, pad, _kind(width)).tobytes()
        group = table.column("group")[0].as_py()
        out = []
        for n, held in enumerate(best_fit_decreasing(sizes, length)):
            joined = b"".join(raw[i] for i in held)
            ends = np.concatenate([[0], np.cumsum(sizes[held])]).astype(np.int32)
            out.append((group << 32 | n, joined + empty[len(joined):], ends, ends[:-1],
                        [{"doc": docs[i], "piece": pieces[i], "start": pieces[i] * length} for i in held]))
        kind = pa.list_(pa.struct([("doc", table.schema.field("doc").type), ("piece", pa.int32()), ("start", pa.int64())]))
        types = (pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), kind)
        return pa.table([pa.array(x, t) for x, t in zip(zip(*out), types)], names=["sequence_id", "ids", "cu_seqlens", "resets", "segments"])
    return fill


def write_matrices(
    docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", path: str = "word_bpe_49k.json",
    end: int = 49407, pad: int = 0, length: int = LENGTH, width: int = 2,
) -> DataFrame:
    """Pack ``docs`` into Parquet files below ``folder``; returns them as read back.

    Columns: sequence_id, ids, cu_seqlens, resets, segments (doc, piece, start).
    """
    total = docs.agg(F.sum(F.octet_length(F.col(text)).cast("long")).alias("n"), F.count("*").alias("rows")).first()
    groups = max(64, -(-((total["n"] or 0) + total["rows"] * 8) // GROUP_BYTES))
    rows = docs.select(
        F.col(key).alias("doc"), F.col(text).cast("string").alias("text"),
        F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(groups)).alias("group"))
    kind = rows.schema["doc"].dataType.simpleString()
    cut = rows.mapInArrow(_cut(path, end, length, width), f"group long, doc {kind}, piece int, ids binary")
    packed = cut.groupBy("group").applyInArrow(
        _fill(length, width, pad), "sequence_id long, ids binary, cu_seqlens array<int>, resets array<int>, "
        f"segments array<struct<doc:{kind},piece:int,start:long>>")
    packed.write.option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.schema(packed.schema).parquet(folder)


def _segments(width: int):
    def read(batches):
        import zlib

        for batch in batches:
            at, out = [], []
            for i, (ids, ends, resets) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("ids", "cu_seqlens", "resets")))):
                for a, b, reset in zip(ends, ends[1:], resets):
                    values = np.frombuffer(ids, _kind(width), b - a, a * width).astype("<u4")
                    at.append(i)
                    out.append((a, b - a, reset, zlib.crc32(values.tobytes())))
            segments = batch.column("segments").flatten()
            a, n, reset, crc = (np.array(x, np.int64) for x in zip(*out)) if out else [np.zeros(0, np.int64)] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("sequence_id").take(pa.array(at, pa.int64())), *(pc.struct_field(segments, f) for f in ("doc", "piece", "start")),
                 pa.array(a), pa.array(n), pa.array(reset), pa.array(crc)],
                ["sequence_id", "doc", "piece", "start", "offset", "length", "reset", "ids_crc32"])
    return read


def segments(matrices: DataFrame, width: int = 2) -> DataFrame:
    """One row per segment of the matrices, with a checksum of its ids (as 4-byte little-endian)."""
    kind = matrices.schema["segments"].dataType.elementType["doc"].dataType.simpleString()
    return matrices.mapInArrow(
        _segments(width), f"sequence_id long, doc {kind}, piece int, start long, offset long, length long, reset long, ids_crc32 long")


def matrices_folder(spark) -> str:
    return scratch_path(spark, "matrices")
