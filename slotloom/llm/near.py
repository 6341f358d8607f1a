"""Near duplicates by ProbMinHash: signatures, banding, verification, classes.

*Weighted shingles.* A text's shingles are its runs of five words; a text of one to four words is one shingle. A
shingle that occurs c times weighs ``1 + ln c``.

*ProbMinHash.* Each shingle starts a Poisson process with its weight as rate; each arrival falls on one of ``bands
* rows`` registers, and a register keeps the shingle that arrives first. Arrivals are functions of the shingle alone,
so two texts agree on a register with the probability Jaccard similarity of their weights. A process ends as soon
as its next arrival is later than the latest register of its text.

*Banding.* A band's registers are one key. Texts that share a key are candidates. As a link is defined by sets, a text in
which a shingle recurs also has the bands of the same process with weight 1, where two texts agree on a register with
the Jaccard similarity of their sets (a text without such a shingle has these bands already). Registers are independent,
so a pair of set similarity s shares a band with a chance of at least ``1 - (1 - s ** rows) ** bands``, whatever the
counts: 0.99992 for 24 bands of 5 at 0.8, and more above. Equal texts are one node from the start, and nodes that share a
key with another are numbered. No bucket is gathered and its pairs are not listed: the text that shares the most buckets with
others is its pivot, and only pairs with the pivot are compared. Classes grow by the verified links, and a bucket is done when
all its members are in one class. What is left in open buckets (texts close to a group but not close enough) goes through one exact
similarity join by prefixes of rare shingles, with size and position bounds, which finds every link among it.

*Verification.* A candidate pair first compares sketches, a byte for each register of the process with weight 1; a pair that agrees on fewer
than ``least_agreeing`` of them (72 of 120, 5.5 standard deviations below what 0.8 gives, a chance of 1e-7) is no link. Only then do the
shingle sets meet, and a link needs a Jaccard similarity of at least ``similarity``, counted exactly.
Classes are the connected components of the links, found by contraction in Spark.

Defined results: a null text and a text without words is in no class but its own; copies and
repeated rows share a class; a null id comes last when the smallest id of a class is chosen.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotloom.llm.words import Slice, mix, slices, windows
from slotloom.session import broadcast_if_small, stage

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
# Bytes of text and rows that a worker takes at once.
SLICE_BYTES, FEW_ROWS = 1 << 20, 512
# Rows of a text with very many copies are dealt into so many parts.
PARTS = 64

_STEP = 0x9E3779B97F4A7C15
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingles(part: Slice, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, counts, row, first of each row) of the distinct shingles of a slice's texts, sorted within a row."""
    hashes, lengths = part.hashes(), np.diff(part.first)
    starts = np.flatnonzero(part.room(size))
    rows, values = part.row_of_word()[starts], windows(hashes, size, _STEP)[starts] if len(starts) else np.zeros(0, np.uint64)
    short = np.flatnonzero((lengths > 0) & (lengths < size))
    if len(short):
        whole = np.array([mix(np.bitwise_xor.accumulate(mix(hashes[part.first[r]:part.first[r + 1]] + np.arange(lengths[r], dtype=np.uint64) * _GOLDEN))[-1:])[0] for r in short], np.uint64)
        rows, values = np.concatenate([rows, short]), np.concatenate([values, whole])
    order = np.argsort(values, kind="stable")
    order = order[np.argsort(rows[order], kind="stable")]
    rows, values = rows[order], values[order]
    new = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])])) if len(rows) else np.zeros(0, np.int64)
    counts = np.diff(np.append(new, len(rows)))
    rows = rows[new]
    return values[new], counts, rows, np.searchsorted(rows, np.arange(part.high - part.low + 1))


def signatures(values: np.ndarray, weights: np.ndarray, rows: np.ndarray, n_rows: int, registers: int) -> np.ndarray:
    """A ``n_rows`` x ``registers`` array of the shingles that arrive first."""
    first = np.full(n_rows * registers, np.inf)
    winner = np.zeros(n_rows * registers, dtype=np.uint64)
    latest = np.full(n_rows, np.inf)
    value, weight, row, time = values, weights.astype(np.float64), rows.astype(np.int64), np.zeros(len(values))
    turn, refresh = 0, 1
    while len(value):
        turn += 1
        bits = mix(value + np.uint64(turn * _STEP & (1 << 64) - 1))
        time = time - np.log(((mix(bits ^ _GOLDEN) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / weight
        alive = time < latest[row]
        if not alive.all():
            value, weight, row, time, bits = value[alive], weight[alive], row[alive], time[alive], bits[alive]
            if not len(value):
                break
        at = row * registers + (bits >> np.uint64(33)).astype(np.int64) % registers
        np.minimum.at(first, at, time)
        won = first[at] == time
        winner[at[won]] = value[won]
        if turn >= refresh:
            some = np.unique(row) if len(row) < n_rows else np.arange(n_rows)
            latest[some] = first.reshape(n_rows, registers)[some].max(axis=1)
            refresh = turn + max(1, turn // 8)
    return winner.reshape(n_rows, registers)


def _band_keys(signed: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key per text and band."""
    signed = signed.reshape(-1, bands, rows)
    keys = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), signed.shape[:2])
    for i in range(rows):
        keys = mix(keys * _GOLDEN + signed[:, :, i])
    return keys


def _bands(bands: int, rows: int):
    def scan(batches):
        for batch in batches:
            key = batch.column("key")
            for part in slices(batch.column("text"), SLICE_BYTES):
                values, counts, row, first = shingles(part)
                n = part.high - part.low
                keys = _band_keys(signatures(values, 1 + np.log(counts), row, n, bands * rows), bands, rows)
                some = np.flatnonzero(np.diff(first) > 0)
                at, out = np.repeat(part.low + some, bands), keys[some].reshape(-1)
                uneven = np.bincount(row[counts > 1], minlength=n) > 0
                if uneven.any():
                    # the bands of the sets; both kinds share their keys, so they meet those of texts without repeats
                    place, of = np.cumsum(uneven) - 1, uneven[row]
                    alike = _band_keys(
                        signatures(values[of], np.ones(int(of.sum())), place[row[of]], int(uneven.sum()), bands * rows), bands, rows)
                    new = alike != keys[uneven]
                    at = np.concatenate([at, part.low + np.flatnonzero(uneven)[np.nonzero(new)[0]]])
                    out = np.concatenate([out, alike[new]])
                yield pa.RecordBatch.from_arrays([key.take(pa.array(at)), pa.array(out.view(np.int64))], ["key", "bucket"])
    return scan


def _few(batches):
    """The rows of batches in small batches, so that a worker holds few texts or sets at once."""
    for batch in batches:
        for low in range(0, batch.num_rows, FEW_ROWS):
            yield batch.slice(low, FEW_ROWS)


def _packed(batches):
    import zstandard

    press = zstandard.ZstdCompressor(level=3)
    for batch in _few(batches):
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.array([press.compress(t or b"") for t in texts], pa.binary())], ["node", "packed"])


def _sets(registers: int):
    """node, size, held (the shingles in order), sketch (the low byte of each register, by weight 1)."""
    def sets(batches):
        import zstandard

        open_ = zstandard.ZstdDecompressor()
        for batch in _few(batches):
            texts = pa.array([open_.decompress(t) for t in batch.column("packed").to_pylist()], pa.large_binary())
            for part in slices(texts, SLICE_BYTES):
                values, _, row, first = shingles(part)
                n, raw = part.high - part.low, values.tobytes()
                low = (signatures(values, np.ones(len(values)), row, n, registers) & np.uint64(255)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(part.low, n), pa.array(np.diff(first), pa.int64()),
                     pa.array([raw[8 * a:8 * b] for a, b in zip(first[:-1], first[1:])], pa.binary()),
                     pa.array([x.tobytes() for x in low], pa.binary())], ["node", "size", "held", "sketch"])
    return sets


def least_agreeing(similarity: float, registers: int) -> int:
    """Registers on which a pair of this similarity agrees at least, but for 5.5 standard deviations."""
    return max(0, int(registers * similarity - 5.5 * (registers * similarity * (1 - similarity)) ** 0.5))


def _alike(similarity: float, registers: int):
    least = least_agreeing(similarity, registers)

    def compare(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, registers) for c in ("a_sketch", "b_sketch"))
                yield batch.select(["a", "b"]).filter(pa.array((a == b).sum(1) >= least))
    return compare


def _similar(similarity: float):
    def compare(batches):
        for batch in _few(batches):
            keep = []
            for a, b in zip(batch.column("a_held").to_pylist(), batch.column("b_held").to_pylist()):
                both = np.concatenate([np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)])
                both.sort(kind="stable")  # two sorted runs
                common = int((both[1:] == both[:-1]).sum())
                keep.append(common + 1e-9 >= similarity * (len(both) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return compare


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float, registers: int) -> DataFrame:
    """The pairs (a, b) of nodes that are links."""
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("size").alias(f"{side}_size"), F.col("sketch").alias(f"{side}_sketch")), side)
    fits = F.least("a_size", "b_size") + 1e-9 >= similarity * F.greatest("a_size", "b_size")
    likely = pairs.where(fits).select("a", "b", "a_sketch", "b_sketch").mapInArrow(_alike(similarity, registers), "a long, b long")
    for side in ("a", "b"):
        likely = likely.join(sets.select(F.col("node").alias(side), F.col("held").alias(f"{side}_held")), side)
    return stage(likely.select("a", "b", "a_held", "b_held").mapInArrow(_similar(similarity), "a long, b long"), "links")


def _contract(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes`` (node, class) after the links (a, b) between nodes joined some of them."""
    def ends(edges: DataFrame, names: DataFrame, old: str, new: str) -> DataFrame:
        for side in ("a", "b"):
            edges = edges.join(names.select(F.col(old).alias(side), F.col(new).alias("_to")), side, "left").withColumn(
                side, F.coalesce("_to", side)).drop("_to")
        return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    edges, moves = stage(ends(links, classes, "node", "class"), "edges"), []
    while not edges.isEmpty():
        # every class goes over to its smallest neighbour, if that is smaller, and on to where that one goes;
        # nodes are numbered by their hash, so chains are short
        parents = edges.groupBy(F.col("b").alias("class")).agg(F.min("a").alias("to"))
        hop = parents.select(F.col("class").alias("to"), F.col("to").alias("further"))
        for _ in range(2):
            parents = parents.join(hop, "to", "left").select("class", F.coalesce("further", "to").alias("to"))
        moves.append(stage(parents, "moves"))
        edges = stage(ends(edges, moves[-1], "class", "to"), "edges")
    for move in moves:
        classes = classes.join(move, "class", "left").select("node", F.coalesce("to", "class").alias("class"))
    return stage(classes, "classes") if moves else classes


def classes_of(keyed: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(key, class) of the texts that share a key with another text. ``keyed``: key (a digest of the text), text."""
    listed = stage(keyed.select("key", "text").mapInArrow(_bands(bands, rows), "key binary, bucket long"), "bands")
    shared = listed.groupBy("bucket").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count("*").alias("n")).where("low <> high")
    members = stage(listed.join(broadcast_if_small(stage(shared.select("bucket", "n"), "buckets"), "bucket"), "bucket").groupBy("bucket", "key").agg(
        F.max("n").alias("n")), "members")
    # how much of the collection a text is close to: the middle of a group of near copies ranks above its copies
    nodes = stage(members.groupBy("key").agg(F.sum("n").alias("weight")).withColumn("node", F.monotonically_increasing_id()), "nodes")
    placed = stage(members.select("bucket", "key").join(nodes, "key").select("bucket", "node", "weight"), "placed")
    texts = keyed.select("key", "text").join(broadcast_if_small(nodes.select("key", "node"), "key"), "key").select("node", "text").mapInArrow(
        _packed, "node long, packed binary").groupBy("node").agg(F.first("packed").alias("packed"))
    sets = stage(texts.mapInArrow(_sets(bands * rows), "node long, size long, held binary, sketch binary"), "sets")
    pivots = placed.groupBy("bucket").agg(F.max(F.struct("weight", "node")).getField("node").alias("pivot"))
    spokes = stage(placed.join(broadcast_if_small(stage(pivots, "pivots"), "bucket"), "bucket").where("node <> pivot").select("bucket", "node", "pivot"), "spokes")
    pairs = spokes.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    classes = _contract(nodes.select("node", F.col("node").alias("class")), _verified(pairs, sets, similarity, bands * rows))
    # the pivot has met all; a bucket whose other members are in one class is done
    named = spokes.select("bucket", "node").join(classes, "node")
    open_ = named.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high").select("bucket")
    left = stage(named.join(broadcast_if_small(stage(open_, "open_buckets"), "bucket"), "bucket").select("node", "class").distinct(), "left")
    if not left.isEmpty():
        classes = _contract(classes, _verified(_close_pairs(left, sets, similarity), sets, similarity, bands * rows))
    return classes.join(nodes.select("node", "key"), "node").select("key", "class")


def _tokens(batches):
    for batch in _few(batches):
        held = [np.frombuffer(x, np.int64) for x in batch.column("held").to_pylist()]
        at = pa.array(np.repeat(np.arange(len(held)), [len(x) for x in held]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("node").take(at), pa.array(np.concatenate([*held, np.zeros(0, np.int64)]))], ["node", "token"])


def _close_pairs(left: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs of nodes of different classes that may reach the similarity, by prefix filtering.

    Two sets of sizes m and n that are so similar have ``need = similarity / (1 + similarity) * (m + n)`` shingles in common, so
    they share one among the first ``m - need + 1`` and ``n - need + 1``, in any order that is the same for all. Shingles
    of one text alone come first; they are counted, but only shared ones move on.
    """
    tokens = stage(left.join(sets.select("node", "held"), "node").mapInArrow(_tokens, "node long, token long"), "tokens")
    often = stage(tokens.groupBy("token").agg(F.count("*").alias("n")).where("n > 1"), "often")
    ordered = tokens.join(broadcast_if_small(often, "token"), "token").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("n", "token"))).alias("shared"))
    sized = ordered.join(left, "node").join(sets.select("node", "size"), "node")
    place = F.col("size") - F.size("shared") + F.col("at")
    # no partner of a set is smaller than ``similarity`` of it
    found = stage(sized.select("node", "class", "size", "shared", F.posexplode("shared").alias("at", "entry")).select(
        "node", "class", "size", place.alias("place"), F.col("entry.token").alias("token")).where(
        F.col("place") <= F.col("size") - F.ceil(F.col("size") * similarity - 1e-9)), "prefixes")
    a, b = (found.select("token", *[F.col(c).alias(f"{side}_{c}") for c in ("node", "class", "size", "place")]) for side in "ab")
    need = F.ceil((F.col("a_size") + F.col("b_size")) * (similarity / (1 + similarity)) - 1e-9)
    return a.join(b, "token").where(
        (F.col("a_node") < F.col("b_node")) & (F.col("a_class") != F.col("b_class")) & (F.col("a_place") <= F.col("a_size") - need)
        & (F.col("b_place") <= F.col("b_size") - need)).select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct()


def digest_of(text):
    """What tells texts apart: null for a text without words."""
    text = text.cast("string")
    return F.when(text.rlike(r"[^\x20\x09-\x0D]"), F.unhex(F.md5(text.cast("binary"))))


def _narrow(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(id, key) of each row, and (key, text) of those with words."""
    digest = digest_of(F.col(f"`{text}`"))
    return docs.select(F.col(f"`{key}`").alias("id"), digest.alias("key")), docs.select(
        digest.alias("key"), F.col(f"`{text}`").cast("string").alias("text")).where("key is not null")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, carry: list[str] | None = None) -> DataFrame:
    """Each row of ``docs`` as ``row`` (a struct of the columns in ``carry``, all by default), with ``class_id``, the smallest id of its class."""
    names = docs.columns if carry is None else carry
    ids, keyed = _narrow(docs, key, text)
    classes = classes_of(keyed, similarity)
    # copies of a text meet by its digest, with map-side sums; only then do digests meet in classes
    copies = stage(ids.where("key is not null").groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("n")), "copies")
    named = copies.join(classes, "key", "left").where("n > 1 or class is not null")
    smallest = stage(named.where("class is not null").groupBy("class").agg(F.min("id").alias("class_id")), "smallest")
    named = stage(named.join(broadcast_if_small(smallest, "class"), "class", "left").select("key", "n", F.coalesce("class_id", "id").alias("class_id")), "named")
    # rows of a text with a thousandth of all copies or more are dealt over tasks, as are rows without words, which meet no class
    heavy = max(1000, (copies.agg(F.sum("n")).first()[0] or 0) // 1000)
    many = [bytes(r["key"]) for r in named.where(F.col("n") > heavy).select("key").collect()]  # 1000 at most
    salt = F.floor(F.rand(3) * PARTS).cast("int")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(f"`{key}`").alias("id"), digest_of(F.col(f"`{text}`")).alias("key"))
    hot = F.col("key").isin(many) if many else F.lit(False)
    rows = rows.select("row", "id", F.when(F.col("key").isNull(), -1).when(hot, salt).otherwise(0).alias("part"),
        F.coalesce("key", F.monotonically_increasing_id().cast("string").cast("binary")).alias("key"))
    named = named.select("key", "class_id", F.explode(F.when(F.col("n") > heavy, F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))).alias("part"))
    return rows.join(named, ["key", "part"], "left").select("row", F.coalesce("class_id", "id").alias("class_id"))


def first_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class: one with the smallest id. Rows without words all stay. Whole rows move once."""
    ids, keyed = _narrow(docs, key, text)
    classes = stage(classes_of(keyed, similarity), "classes_by_key")
    last = lambda name: F.struct(F.col(name).isNull().alias("gone"), F.col(name).alias("id"))
    texts = stage(ids.join(broadcast_if_small(classes, "key"), "key").groupBy("class", "key").agg(F.min(last("id")).alias("id")), "copies")
    chosen = texts.groupBy("class").agg(F.min(F.struct("id", "key")).getField("key").alias("key"))
    losers = texts.select("key").join(chosen, "key", "left_anti")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), last(f"`{key}`").alias("id"), digest_of(F.col(f"`{text}`")).alias("key"))
    once = rows.where("key is not null").groupBy("key").agg(F.min_by("row", "id").alias("row")).join(losers, "key", "left_anti")
    return rows.where("key is null").select("row").unionByName(once.select("row")).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
