"""Repeated passages: confirmed by counting, compiled into sharded automata, located in every text.

A window is ``size`` consecutive words of one text. A window recurs when its word sequence also
starts anywhere else in the collection, the same text included. Every word that a recurring window
covers is part of a repeated passage.

1. *Anchors.* Among the grams of eight words in a window, the one with the smallest hash is its anchor
   (the first of equals). Equal windows have equal anchors at equal places, so only windows whose anchor
   occurs twice can recur. One scan counts anchors, with map-side sums; a second lists the anchors
   that recur, each with the *context*: the span of all windows that share this anchor.
2. *Confirmation.* A context that occurs twice recurs as a whole. Where an anchor has several
   contexts, one text of each sends the hashes of its windows, and these are counted.
3. *Automata.* Texts go to shards by hash. A shard gets one reference to each confirmed passage that
   its texts hold, compiles the passages into Aho-Corasick automata over word codes, and streams
   all its texts through them. Each occurrence found marks its words.

Hot passages cost one counted row per task and one pattern per shard; no group of occurrences is
ever gathered. Texts move twice, compressed.

Defined results: a null text has no words and stays null in ``repeated_words``; an empty text stays
empty. Copies and repeated rows count as occurrences, so a text of ``size`` words or more that occurs
twice loses all its words. Words are compared as bytes, by 64-bit hashes; windows by 128 bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotloom.llm.words import Slice, mix, slices, windows, least
from slotloom.session import stage

GRAM = 8
SHARD_BYTES = 6 << 20
LEAST_SHARDS = 64
# Word codes are code points, of which about 1.1 million exist.
CODES = 1_000_000

_GRAM_STEP, _SPAN_STEP, _OTHER_STEP = 0x9E3779B97F4A7C55, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9


def _contexts(part: Slice, size: int):
    """(anchor hash, context hash, row, first window, number of windows), one entry per context."""
    hashes = part.hashes()
    starts = np.flatnonzero(part.room(size))
    if not len(starts):
        return None
    grams = windows(hashes, GRAM, _GRAM_STEP)
    spans = windows(hashes, size, _SPAN_STEP)
    anchor = least(grams, size - GRAM + 1)[starts]
    begins = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (np.diff(starts) != 1)]))
    first, many = starts[begins], np.diff(np.append(begins, len(starts)))
    place = (anchor[begins] - first).astype(np.uint64)
    context = mix(mix(mix(spans[first]) + spans[first + many - 1]) + place * np.uint64(64) + many.astype(np.uint64))
    rows = np.searchsorted(part.first, first, side="right") - 1
    return grams[anchor[begins]], context, rows, first - part.first[rows], many


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _scan_anchors(size: int):
    def scan(batches):
        for batch in batches:
            for part in slices(batch.column("text")):
                found = _contexts(part, size)
                if found:
                    yield pa.RecordBatch.from_arrays([_signed(found[0])], ["anchor"])
    return scan


def _scan_contexts(size: int):
    def scan(batches):
        for batch in batches:
            shard, key = batch.column("shard").to_numpy(), batch.column("key").to_numpy()
            for part in slices(batch.column("text")):
                found = _contexts(part, size)
                if found:
                    anchor, context, rows, first, many = found
                    yield pa.RecordBatch.from_arrays(
                        [_signed(anchor), _signed(context), pa.array(shard[part.low + rows]),
                         pa.array(key[part.low + rows]), pa.array(first * 64 + many)],
                        ["anchor", "context", "shard", "key", "span"])
    return scan


def _packed(batches):
    """Texts compressed for the exchange."""
    import zstandard

    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        small = pa.array([None if t is None else press.compress(t) for t in texts], pa.binary())
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, "text", small)


def _unpacked(column) -> pa.Array:
    import zstandard

    open_ = zstandard.ZstdDecompressor()
    return pa.array([None if t is None else open_.decompress(t) for t in column.to_pylist()], pa.large_binary())


def _window_hashes(size: int):
    def hashes(docs: pa.Table, wanted: pa.Table) -> pa.Table:
        """For each wanted context of the shard, the hashes of its windows."""
        out: list[tuple[np.ndarray, ...]] = []
        if wanted.num_rows and docs.num_rows:
            keys, key = docs.column("key").to_numpy(), wanted.column("key").to_numpy()
            order = np.argsort(key, kind="stable")
            anchor, context, span, twice = (wanted.column(c).to_numpy()[order] for c in ("anchor", "context", "span", "twice"))
            key = key[order]
            _, once = np.unique(keys, return_index=True)  # copies of a text say the same
            once = np.sort(once[np.isin(keys[once], key)])
            texts = _unpacked(docs.column("text").take(pa.array(once)))
            for part in slices(texts):
                wide = windows(part.hashes(), size, _OTHER_STEP)
                for row in range(part.low, part.high):
                    low, high = np.searchsorted(key, keys[once[row]], "left"), np.searchsorted(key, keys[once[row]], "right")
                    begin = part.first[row - part.low] + span[low:high] // 64
                    many = span[low:high] % 64
                    which = np.repeat(np.arange(low, high), many)
                    offset = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
                    out.append((which, offset, wide[np.repeat(begin, many) + offset]))
        if not out:
            return pa.table({c: pa.array([], pa.int64()) for c in ("anchor", "context", "place", "window", "twice")})
        which, offset, wide = (np.concatenate(x) for x in zip(*out))
        return pa.table({"anchor": anchor[which], "context": context[which], "place": offset.astype(np.int64),
                         "window": wide.view(np.int64), "twice": twice[which]})
    return hashes


def _runs(places):
    """Sorted places as runs of (first, number), packed like a span."""
    kept = F.filter(places, lambda x: ~F.array_contains(places, x - 1))
    ends = F.filter(places, lambda x: ~F.array_contains(places, x + 1))
    return F.zip_with(F.array_sort(kept), F.array_sort(ends), lambda a, b: a * 64 + b - a + 1)


def _cover(part: Slice, refs: list[tuple[int, int]], size: int) -> np.ndarray:
    """Which words of the slice's texts are covered, by automata compiled from the referenced spans."""
    import ahocorasick

    hashes = part.hashes()
    delta = np.zeros(len(hashes) + 1, dtype=np.int32)
    while refs:
        take, words = 0, 0
        while take < len(refs) and (take == 0 or words + refs[take][1] <= CODES):
            words += refs[take][1]
            take += 1
        now, refs = refs[:take], refs[take:]
        known = np.unique(np.concatenate([hashes[a:a + n] for a, n in now]))
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        codes = at + 1
        codes = np.where(known[at] == hashes, codes + np.where(codes >= 0xD800, 0x800, 0), 0).astype("<u4")
        automaton = ahocorasick.Automaton()
        for a, n in now:
            automaton.add_word(codes[a:a + n].tobytes().decode("utf-32-le"), n)
        automaton.make_automaton()
        for row in range(part.high - part.low):
            low, high = part.first[row], part.first[row + 1]
            if high - low < size or not codes[low:high].any():
                continue
            for end, n in automaton.iter(codes[low:high].tobytes().decode("utf-32-le")):
                delta[low + end + 1 - n] += 1
                delta[low + end + 1] -= 1
    return np.cumsum(delta[:-1]) > 0


def _kept_texts(part: Slice, covered: np.ndarray) -> list[bytes]:
    """Per text, the words that stay, joined by one space."""
    stay = np.flatnonzero(~covered)
    starts, sizes = part.starts[stay], part.ends[stay] - part.starts[stay] + 1  # with a place for the space
    ends = np.cumsum(sizes)
    source = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)
    joined = part.data[np.minimum(source, len(part.data) - 1)] if len(source) else np.zeros(0, np.uint8)
    joined[ends - 1] = 0x20
    raw = joined.tobytes()
    at = np.searchsorted(stay, part.first)
    edge = np.concatenate([[0], ends])[at]
    return [raw[a:max(a, b - 1)] for a, b in zip(edge[:-1], edge[1:])]


def _locate(size: int):
    def locate(docs: pa.Table, refs: pa.Table) -> pa.Table:
        """The shard's texts without their covered words."""
        n_words, n_removed, kept = [], [], []
        keys = docs.column("key").to_numpy()
        texts = _unpacked(docs.column("text"))
        nulls = texts.is_null().to_pylist()
        # A passage is compiled once in a slice, from any text that holds it.
        by_key: dict[int, list[tuple]] = {}
        for key, span, *passage in zip(*(refs.column(c).to_pylist() for c in ("key", "span", "anchor", "context", "place"))):
            by_key.setdefault(key, []).append((span, *passage))
        for part in slices(texts):
            chosen: dict[tuple, tuple[int, int]] = {}
            for row in range(part.low, part.high):
                low, room = int(part.first[row - part.low]), int(part.first[row - part.low + 1])
                for span, *passage in by_key.get(int(keys[row]), ()):
                    begin, many = low + span // 64, span % 64 + size - 1
                    if begin + many <= room:
                        chosen.setdefault(tuple(passage), (begin, many))
            covered = _cover(part, list(chosen.values()), size)
            counts = np.concatenate([[0], np.cumsum(covered)])
            n_words.append(np.diff(part.first))
            n_removed.append(counts[part.first[1:]] - counts[part.first[:-1]])
            kept.extend(_kept_texts(part, covered))
        digests = [hashlib.sha256(t).hexdigest() for t in kept]
        return pa.table({
            "row": docs.column("row").combine_chunks(), "n_words": np.concatenate(n_words), "n_removed": np.concatenate(n_removed),
            "kept_sha256": digests, "kept_text": pa.array([None if gone else t for t, gone in zip(kept, nulls)], pa.binary()).cast(pa.string()),
        })
    return locate


def drop_repeats(docs: DataFrame, text: str = "text", size: int = 35) -> DataFrame:
    """Each row of ``docs`` as ``row`` (a struct of all its columns but the text), and its text without repeated passages.

    Columns: row, n_words, n_removed, kept_sha256, kept_text (kept words joined by one space; null for a null text).
    ``size`` may be 12 to 63 words.
    """
    if not 12 <= size <= 63:
        raise ValueError("size must be 12 to 63 words")
    total = docs.agg(F.sum(F.octet_length(F.col(text)).cast("long")).alias("n")).first()["n"] or 0
    shards = max(LEAST_SHARDS, -(-total // SHARD_BYTES))
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    ids = F.xxhash64(F.col(text), *[c for c in others if docs.select(c).schema[0].dataType.typeName() not in ("map", "variant")])
    rows = docs.select(
        F.struct(*others, F.lit(0).alias("_")).alias("row") if not others else F.struct(*others).alias("row"),
        F.col(text).cast("string").alias("text"), F.pmod(ids, F.lit(shards)).cast("int").alias("shard"),
        F.xxhash64(F.col(text), F.lit("key")).alias("key"))

    again = stage(
        rows.select("text").mapInArrow(_scan_anchors(size), "anchor long")
        .groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "anchors")
    found = stage(
        rows.select("text", "shard", "key").mapInArrow(_scan_contexts(size), "anchor long, context long, shard int, key long, span long")
        .join(again, "anchor"), "contexts")
    contexts = found.groupBy("anchor", "context").agg(
        F.count("*").alias("n"), F.max(F.struct("key", "shard", "span")).alias("of"))
    contexts = stage(contexts, "context_counts")
    several = contexts.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1").select("anchor")
    open_ = stage(contexts.join(several, "anchor").select(
        "anchor", "context", "of.shard", "of.key", "of.span", F.least(F.col("n"), F.lit(2)).alias("twice")), "open_contexts")

    small = rows.mapInArrow(_packed, rows.withColumn("text", F.col("text").cast("binary")).schema)
    counted = stage(
        small.select("text", "shard", "key").groupBy("shard").cogroup(open_.groupBy("shard"))
        .applyInArrow(_window_hashes(size), "anchor long, context long, place long, window long, twice long"), "window_hashes")
    recurring = counted.groupBy("anchor", "window").agg(F.sum("twice").alias("n")).where("n > 1").select("anchor", "window")
    partly = counted.where("twice = 1").join(recurring, ["anchor", "window"]).groupBy("anchor", "context").agg(
        F.collect_list("place").alias("places")).select("anchor", "context", F.explode(_runs(F.col("places"))).alias("run"))
    whole = contexts.where("n > 1").select("anchor", "context", (F.col("of.span") % 64).alias("run"))
    passages = stage(partly.unionByName(whole), "passages")

    refs = found.join(passages, ["anchor", "context"]).select(
        "shard", "key", "anchor", "context", F.floor(F.col("run") / 64).alias("place"),
        (F.floor(F.col("span") / 64) * 64 + F.col("run")).alias("span"))
    row_type = rows.schema["row"].dataType.simpleString()
    return small.groupBy("shard").cogroup(refs.groupBy("shard")).applyInArrow(
        _locate(size), f"row {row_type}, n_words long, n_removed long, kept_sha256 string, kept_text string")
