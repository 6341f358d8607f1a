"""Ranked lexical search by NRA: impact-sorted lists read in order, score intervals per document, no look-ups.

*Terms* are runs of letters, digits and characters beyond ASCII, with A-Z in lower case. A term's weight w is
``floor(1000 * ln((2N + 2) / (2 df + 1)))``; a document's score is the sum, over the item's terms with repeats, of its
*impacts* ``w * ((10^9 tf) div (1000 tf + 8 m))``, with m its length norm.

*Index.* One pass over the documents writes, for each run of documents (a *shard*, about ``SHARD_POSTINGS`` entries),
the postings of the items' terms, and counts documents and terms. Document frequencies are summed from the shards.

*Search.* Within a shard each term's list is sorted by impact, highest first. For an item, all its lists are read in order down to a
threshold, which is halved from turn to turn. What was read is a document's lower bound; what was read plus the next
impact of each list in which the document was not yet met is its upper bound. Documents not met at all have an upper bound
too. Reading ends when none of those can reach the k best, and every document that still can has been met in each
list that is not read to its end, so members, ties and scores are final. A task hands the k best
of its earlier shards to the next one as the score to reach, and sends k rows per item to the merge.

Items come in blocks of about ``BLOCK_BYTES`` of text (one block unless the items are very many), whose terms reach every task.
Tasks need no shuffle of documents or postings, so a common term costs no task more than its own documents.

Defined results: a null or empty text, of documents or of items, has no terms; such items get no rows. Documents without terms do
not count. Repeated rows are documents of their own; equal (id, text) rows of items are one item. Equal scores are
ordered by id, a null id last. Ids are whole numbers. No documents, no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotloom.llm.words import Slice, slices
from slotloom.session import stage

SHARD_POSTINGS = 500_000
BLOCK_BYTES = 4 << 20

BLANK = np.ones(256, dtype=bool)
BLANK[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

_INDEX = "docs binary, known binary, sizes binary, term binary, doc binary, often binary, counted long, total long"


def terms(texts: pa.Array):
    """Slices of a column of texts, cut into terms in lower case."""
    for part in slices(texts, blank=BLANK):
        yield Slice(part.low, part.high, _LOWER[part.data], part.offsets, part.starts, part.ends, part.first)


def _counted(part: Slice, hashes: np.ndarray, vocabulary: np.ndarray):
    """(term, row, times) of the vocabulary's terms in a slice; ``vocabulary``: sorted hashes."""
    at = np.minimum(np.searchsorted(vocabulary, hashes), max(0, len(vocabulary) - 1))
    hit = np.flatnonzero(vocabulary[at] == hashes) if len(vocabulary) else np.zeros(0, np.int64)
    pairs, times = np.unique(part.row_of_word()[hit] * max(1, len(vocabulary)) + at[hit], return_counts=True)
    return pairs % max(1, len(vocabulary)), pairs // max(1, len(vocabulary)), times


def index(docs: DataFrame, vocabulary: np.ndarray, key: str = "doc_id", text: str = "text", most: int = SHARD_POSTINGS) -> DataFrame:
    """A row per shard: ids and sizes of its documents, postings (term, document, times), and what all its documents count."""
    def scan(batches):
        held, postings = [], 0
        for batch in batches:
            ids = batch.column("key")
            known = ~ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            for part in terms(batch.column("text")):
                found = _counted(part, part.hashes(), vocabulary)
                held.append((ids[part.low:part.high], known[part.low:part.high], np.diff(part.first), *found))
                postings += len(found[0])
                if postings >= most:
                    yield _shard(held)
                    held, postings = [], 0
        if held:
            yield _shard(held)

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    return stage(rows.mapInArrow(scan, _INDEX), "postings")


def _shard(held: list[tuple]) -> pa.RecordBatch:
    ids, known, sizes, term, doc, times = zip(*held)
    first = np.cumsum([0, *map(len, sizes)])[:-1]
    sizes = np.concatenate(sizes)
    doc = np.concatenate([d + f for d, f in zip(doc, first)])
    # documents without a posting are counted, not kept
    some, doc = np.unique(doc, return_inverse=True)
    columns = (np.concatenate(ids)[some].astype("<i8"), np.concatenate(known)[some], sizes[some].astype("<i8"),
               np.concatenate(term).astype("<i4"), doc.astype("<i4"), np.concatenate(times).astype("<i4"))
    return pa.RecordBatch.from_arrays(
        [*(pa.array([c.tobytes()], pa.binary()) for c in columns), pa.array([int((sizes > 0).sum())]), pa.array([int(sizes.sum())])],
        [c.split()[0] for c in _INDEX.split(", ")])


def _frequencies(shards: DataFrame) -> DataFrame:
    """term, df."""
    def count(batches):
        for batch in batches:
            for held in batch.column("term"):
                term, n = np.unique(np.frombuffer(held.as_buffer(), "<i4"), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(term, pa.int32()), pa.array(n, pa.int64())], ["term", "n"])

    return shards.select("term").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("df"))


def nra(lists: list[tuple[np.ndarray, np.ndarray]], n: int, k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
    """(documents, scores, entries read): all documents that score at least ``floor``, above 0, and no less than the k-th best.

    ``lists``: per term the documents (below ``n``, each once) and their impacts, highest first.
    """
    low, met = np.zeros(n, np.int64), np.zeros((len(lists), n), bool)
    at, heads = [0] * len(lists), np.array([int(g[0]) if len(g) else 0 for _, g in lists], np.int64)
    live, read = None, 0
    while heads.any():
        threshold = max(1, int(heads.max()) // 2)
        for t in np.flatnonzero(heads >= threshold).tolist():
            docs, gains = lists[t]
            end = at[t] + int(np.searchsorted(-gains[at[t]:], -threshold, "right"))
            some = docs[at[t]:end]
            low[some] += gains[at[t]:end]
            met[t, some] = True
            read += end - at[t]
            at[t], heads[t] = end, int(gains[end]) if end < len(gains) else 0
        least = max(floor, int(np.partition(low, n - k)[n - k]) if n >= k else 0, 1)
        if live is None:
            if heads.sum() >= least:
                continue  # a document not met so far may still be among the best
            live = np.flatnonzero(low)
        unmet = heads[:, None] * ~met[:, live]
        stays = low[live] + unmet.sum(0) >= least
        live, unmet = live[stays], unmet[:, stays]
        if not unmet.any():
            break
    if live is None:
        live = np.flatnonzero(low >= max(floor, int(np.partition(low, n - k)[n - k]) if n >= k else 0, 1))
    return live, low[live], read


def _best(ids, known, scores, k: int):
    order = np.lexsort((ids, ~known, -scores))[:k]
    return ids[order], known[order], scores[order]


def _search(shards: DataFrame, wanted: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray, n: int, total: int, k: int) -> DataFrame:
    """item (a place in ``wanted``), doc, score: the k best of each task's documents for each item."""
    def run(batches):
        best = {}
        for batch in batches:
            for row in range(batch.num_rows):
                raw = [np.frombuffer(batch.column(c)[row].as_buffer(), t) for c, t in (
                    ("docs", "<i8"), ("known", "?"), ("sizes", "<i8"), ("term", "<i4"), ("doc", "<i4"), ("often", "<i4"))]
                ids, known, sizes, term, doc, often = raw
                norm = 25 + (75 * sizes * n) // max(1, total)
                often = often.astype(np.int64)
                gain = weights[term] * ((1_000_000_000 * often) // (1000 * often + 8 * norm[doc]))
                order = np.lexsort((doc, -gain, term))
                order = order[gain[order] > 0]
                term, doc, gain = term[order], doc[order], gain[order]
                begins = np.searchsorted(term, np.arange(len(weights) + 1))
                for item, (own, times) in enumerate(wanted):
                    lists = [(doc[begins[t]:begins[t + 1]], gain[begins[t]:begins[t + 1]] * c)
                             for t, c in zip(own.tolist(), times.tolist()) if begins[t] < begins[t + 1]]
                    if not lists:
                        continue
                    before = best.get(item)
                    found, scores, _ = nra(lists, len(ids), k, int(before[2][-1]) if before is not None and len(before[2]) == k else 0)
                    new = ids[found], known[found], scores
                    best[item] = _best(*(new if before is None else (np.concatenate(x) for x in zip(before, new))), k)
        for item, (ids, known, scores) in best.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), item), pa.int32()), pa.array(ids, pa.int64(), mask=~known), pa.array(scores, pa.int64())],
                ["item", "doc", "score"])

    return shards.drop("counted", "total").mapInArrow(run, "item int, doc long, score long")


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
    shard_postings: int = SHARD_POSTINGS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k best documents of each item, by score and then by id."""
    spark = docs.sparkSession
    asked = items.select(F.col(f"`{item_key}`").alias("id"), F.col(f"`{item_text}`").cast("string").alias("text")).where("text is not null").distinct()
    kind = asked.schema["id"].dataType.simpleString()
    asked = stage(asked, "items")
    blocks = -(-(asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes)
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for block in range(blocks):
        held = asked.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).toArrow()
        texts = held.column("text").combine_chunks()
        parts = [(part, part.hashes()) for part in terms(texts)]
        vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *(h for _, h in parts)]))
        wanted = []
        for part, hashes in parts:
            term, row, times = _counted(part, hashes, vocabulary)
            order = np.argsort(row, kind="stable")
            cuts = np.searchsorted(row[order], np.arange(1, part.high - part.low))
            wanted += zip(np.split(term[order], cuts), np.split(times[order], cuts))
        shards = index(docs, vocabulary, key, text, shard_postings)
        sums = shards.agg(F.sum("counted").alias("n"), F.sum("total").alias("total")).first()
        n, total = sums["n"] or 0, sums["total"] or 0
        weights = np.zeros(len(vocabulary), np.int64)
        weighed = _frequencies(shards).select(
            "term", F.floor(1000 * F.log((F.lit(2.0) * n + 2) / (2.0 * F.col("df") + 1))).cast("long").alias("w")).toArrow()  # a row per term of the block
        weights[weighed.column("term").to_numpy()] = weighed.column("w").to_numpy()
        found = _search(shards, wanted, weights, n, total, k)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame(pa.table({"item": pa.array(range(len(held)), pa.int32()), "item_id": held.column("id")}))
        out = out.unionByName(ranked.join(F.broadcast(names), "item").select("item_id", "rank", F.col("doc").alias("doc_id"), "score"))
    return out
