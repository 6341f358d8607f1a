"""Approximate nearest neighbours by learned partitions.

*Fit*, on a bounded sample of ``FIT_ROWS`` vectors: an exact neighbour graph of the sample, cut into equal
parts by recursive bisection (a slowly mixing vector of the graph's random walk, split at its median, then improved by
swaps across the cut), and a small network with one hidden layer that learns the part of a vector. How many parts a
query has to probe is measured on the sample against brute force.

*Index.* Every row goes to its most probable part. *Search.* A query goes to its most probable parts, as many as were
measured and at least so many that they hold the wanted number of rows. Large parts are dealt into blocks, for rows and
for queries, so no task gets more than a block of each; exact distances rank the rows of a block, and the best
of each block are merged.

Defined results: vectors that are null, zero, of another length than most, or that hold a null or a non-finite
component take no part, nor do rows without an id. Rows with the query's id count as the query's own. Equal distances are
ordered by id; repeated ids are repeated candidates. Tables with fewer rows than asked for give all there are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotloom.session import stage

# The most vectors that a fit reads.
FIT_ROWS = 6_000
NEIGHBOURS, HIDDEN, EPOCHS = 10, 96, 60
LEAST_PARTS, MOST_PARTS, PART_ROWS = 16, 256, 4_000
# The share of true neighbours to reach on the sample, and the sizes of blocks.
RECALL, BLOCK_ROWS, BLOCK_QUERIES = 0.95, 16_000, 2_000


@dataclass
class Router:
    """Probabilities of the parts for a vector."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def neighbours(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other rows of each row."""
    norms, out = (x * x).sum(1), []
    for low in range(0, len(x), 512):
        d = norms[None] - 2 * x[low:low + 512] @ x.T
        d[np.arange(len(d)), np.arange(low, low + len(d))] = np.inf
        out.append(np.argpartition(d, k - 1, axis=1)[:, :k])
    return np.concatenate(out)


def _bisect(links: np.ndarray, members: np.ndarray, seed: np.random.Generator) -> np.ndarray:
    """Which half of the members is on the far side of a balanced cut of the graph among them."""
    n = len(members)
    at = np.full(max(int(links.max()) + 1, int(members.max()) + 1), -1)
    at[members] = np.arange(n)
    a = np.repeat(np.arange(n), links.shape[1])
    b = at[links[members].reshape(-1)]
    a, b = a[b >= 0], b[b >= 0]
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    degree = np.bincount(a, minlength=n) + 1.0
    v = seed.standard_normal(n)
    for _ in range(80):
        v = (v + np.bincount(a, weights=v[b], minlength=n)) / degree
        v -= (v * degree).sum() / degree.sum()
        v /= np.abs(v).max() + 1e-30
    side = np.zeros(n, dtype=bool)
    side[np.argsort(v, kind="stable")[n // 2:]] = True
    for _ in range(8):
        other = np.bincount(a, weights=side[b] != side[a], minlength=n)
        gain = other - (np.bincount(a, minlength=n) - other)
        here, there = np.flatnonzero(~side), np.flatnonzero(side)
        here, there = here[np.argsort(-gain[here], kind="stable")], there[np.argsort(-gain[there], kind="stable")]
        m = min(len(here), len(there))
        good = np.flatnonzero(gain[here[:m]] + gain[there[:m]] > 2)[: max(1, n // 50)]
        if not len(good):
            break
        side[here[good]], side[there[good]] = True, False
    return side


def balanced_parts(links: np.ndarray, parts: int) -> np.ndarray:
    """A part for each vertex; parts differ by a vertex or so. ``parts`` is a power of two."""
    out, seed = np.zeros(len(links), dtype=np.int64), np.random.default_rng(0)
    step = 1
    while step < parts:
        new = out * 2
        for p in np.unique(out):
            members = np.flatnonzero(out == p)
            if len(members) > 1:
                new[members[_bisect(links, members, seed)]] += 1
        out, step = new, step * 2
    return out


def fit(x: np.ndarray, parts: int, k: int = 10) -> Router:
    """A router learnt from a sample."""
    rng, d = np.random.default_rng(1), x.shape[1]
    parts = max(1, min(parts, 1 << max(0, int(np.log2(max(1, len(x) // 32))))))
    mean, scale = x.mean(0), x.std(0) + 1e-12
    if parts == 1:
        return Router(mean, scale, np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)
    links = neighbours(x, min(NEIGHBOURS, len(x) - 1))
    label = balanced_parts(links, parts)
    shape = [(d, HIDDEN), (HIDDEN,), (HIDDEN, parts), (parts,)]
    w = [rng.standard_normal(s) * (2 / s[0]) ** 0.5 if len(s) == 2 else np.zeros(s) for s in shape]
    m, v, turn = [np.zeros(s) for s in shape], [np.zeros(s) for s in shape], 0
    z = (x - mean) / scale
    # a vector's target is spread over the parts of its neighbours
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), links.shape[1]), label[links].reshape(-1)), 0.5 / links.shape[1])
    target[np.arange(len(x)), label] += 0.5
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for low in range(0, len(x), 128):
            some = order[low:low + 128]
            h = np.maximum(z[some] @ w[0] + w[1], 0)
            s = h @ w[2] + w[3]
            p = np.exp(s - s.max(1, keepdims=True))
            g = (p / p.sum(1, keepdims=True) - target[some]) / len(some)
            gh = g @ w[2].T * (h > 0)
            turn += 1
            for i, grad in enumerate((z[some].T @ gh, gh.sum(0), h.T @ g, g.sum(0))):
                m[i] = 0.9 * m[i] + 0.1 * grad
                v[i] = 0.999 * v[i] + 0.001 * grad * grad
                w[i] -= 0.003 * (m[i] / (1 - 0.9 ** turn)) / (np.sqrt(v[i] / (1 - 0.999 ** turn)) + 1e-8)
    router = Router(mean, scale, *w, probes=parts)
    # probes: on the sample, where true neighbours lie among a query's most probable parts
    scores = router.scores(x)
    held, ranks = scores.argmax(1), np.argsort(np.argsort(-scores, axis=1, kind="stable"), axis=1)
    true = neighbours(x, min(k, len(x) - 1))
    depth = ranks[np.repeat(np.arange(len(x)), true.shape[1]), held[true.reshape(-1)]]
    reached = np.cumsum(np.bincount(depth, minlength=parts)) / len(depth)
    router.probes = min(parts, int(np.searchsorted(reached, RECALL)) + 1)
    return router


def _usable(column: pa.Array, size: int | None = None) -> np.ndarray:
    """Which vectors take part."""
    column = column.cast(pa.large_list(pa.float64()))
    sizes = np.diff(column.offsets.to_numpy())
    values = column.values.to_numpy(zero_copy_only=False)
    bad = ~np.isfinite(values)
    ends = column.offsets.to_numpy()
    count = lambda flags: (lambda s: s[ends[1:]] - s[ends[:-1]])(np.concatenate([[0], np.cumsum(flags)]))
    good = ~column.is_null().to_numpy(zero_copy_only=False) & (count(bad) == 0) & (count(values != 0) > 0)
    return good & (sizes == size) if size is not None else good


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.cast(pa.large_list(pa.float64())).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _best(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int):
    """(query, id, distance) of the k nearest rows of the block for each query."""
    norms = (x * x).sum(1)
    for low in range(0, len(q), 64):
        some = q[low:low + 64]
        d = np.maximum(norms[None] - 2 * some @ x.T + (some * some).sum(1)[:, None], 0)
        d[query_ids[low:low + 64][:, None] == ids[None]] = np.inf
        m = min(k, len(x)) - 1
        # rounding may swap near equals, so all that come close to the last one are measured exactly
        bound = np.partition(d, m, axis=1)[:, m]
        bound = np.where(np.isfinite(bound), bound + 1e-9 * (norms.max() + (some * some).sum(1)), np.finfo(float).max)
        for i in range(len(some)):
            near = np.flatnonzero(d[i] <= bound[i])
            exact = np.sqrt(((x[near] - some[i]) ** 2).sum(1))
            order = np.lexsort((ids[near], exact))[:k]
            for j in order:
                yield query_ids[low + i], ids[near[j]], exact[j]


def nearest(
    table: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding", router: Router | None = None,
) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance): the k nearest found in ``table`` for each row of ``queries``."""
    rows = table.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where("id is not null and v is not null")
    asked = queries.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where("id is not null and v is not null")
    sizes = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    empty = "query_id long, rank int, vec_id long, score double"
    if sizes is None or sizes["size"] == 0:
        return table.sparkSession.createDataFrame([], empty)
    size, n = sizes["size"], sizes["n"]
    if router is None:
        share = min(1.0, FIT_ROWS / n)
        drawn = rows.where(F.pmod(F.xxhash64("id", F.lit("fit")), F.lit(1 << 30)) < int(share * (1 << 30))).orderBy("id").limit(2 * FIT_ROWS).toArrow()
        column = drawn.column("v").combine_chunks()
        sample = _matrix(column.filter(pa.array(_usable(column, size))), size)
        wanted = 1 << max(0, (min(MOST_PARTS, max(LEAST_PARTS, n // PART_ROWS)) - 1).bit_length())
        router = fit(sample if len(sample) else np.zeros((1, size)), wanted, k)
    parts = len(router.b2)

    def place(batches):
        for batch in batches:
            good = pa.array(_usable(batch.column("v"), size))
            ids, v = batch.column("id").filter(good), batch.column("v").filter(good)
            part = router.scores(_matrix(v, size)).argmax(1) if len(ids) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([ids, v, pa.array(part, pa.int32())], ["id", "v", "part"])

    index = stage(rows.mapInArrow(place, "id long, v array<double>, part int"), "index")
    held = np.zeros(parts, dtype=np.int64)
    for r in index.groupBy("part").count().collect():  # at most a row per part
        held[r["part"]] = r["count"]

    def route(batches):
        for batch in batches:
            good = pa.array(_usable(batch.column("v"), size))
            ids, v = batch.column("id").filter(good), batch.column("v").filter(good)
            if len(ids):
                order = np.argsort(-router.scores(_matrix(v, size)), axis=1, kind="stable")
                enough = (np.cumsum(held[order], axis=1) < k + 1).sum(1) + 1
                many = np.minimum(np.maximum(router.probes, enough), parts)
                row = np.repeat(np.arange(len(ids)), many)
                to = order[np.arange(parts)[None] < many[:, None]]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(row)), v.take(pa.array(row)), pa.array(to, pa.int32())], ["id", "v", "part"])

    routed = stage(asked.mapInArrow(route, "id long, v array<double>, part int"), "routed")
    sent = np.zeros(parts, dtype=np.int64)
    for r in routed.groupBy("part").count().collect():
        sent[r["part"]] = r["count"]
    row_blocks = F.element_at(F.lit((-(-np.maximum(held, 1) // BLOCK_ROWS)).tolist()), F.col("part") + 1)
    query_blocks = F.element_at(F.lit((-(-np.maximum(sent, 1) // BLOCK_QUERIES)).tolist()), F.col("part") + 1)
    block = lambda blocks: F.pmod(F.xxhash64("id"), blocks)
    dealt = index.withColumn("row_block", block(row_blocks)).withColumn("query_block", F.explode(F.sequence(F.lit(0).cast("long"), query_blocks.cast("long") - 1)))
    asked = routed.withColumn("query_block", block(query_blocks)).withColumn("row_block", F.explode(F.sequence(F.lit(0).cast("long"), row_blocks.cast("long") - 1)))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            x, q = (_matrix(t.column("v").combine_chunks(), size) for t in (left, right))
            found = list(_best(left.column("id").to_numpy(), x, right.column("id").to_numpy(), q, k))
        a, b, c = zip(*found) if found else ((), (), ())
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.float64())], names=["query_id", "vec_id", "score"])

    names = ["part", "row_block", "query_block"]
    found = dealt.groupBy(*names).cogroup(asked.groupBy(*names)).applyInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
