"""Hard negatives by windows of scores, found in a multiway hyperplane tree.

*Measure.* A vector's components become ``floor(scale * x)``; a score is the inner product of two such rows, a whole number. An anchor's positives
are its first rows of the same label, by score and then by id; for each, its hard negatives are the first rows of other labels
whose score s lies in the positive's window, ``low * positive <= 100 * s <= high * positive``.

*Tree.* A bounded sample of ``FIT_ROWS`` rows gives the split points: ``FAN`` points of a node, far from each other, and
a row goes on to the child of its nearest one. All rows are sent down (a leaf each). One grouped pass over them then measures, for each
split point and each of its siblings' subtrees, the range of distances from the point to all rows below, and the range of their lengths.

*Search.* As ``d^2 = |a|^2 + |x|^2 - 2 s``, a window of scores is an annulus around the anchor. By the triangle inequality the
distances d(a, p) to the split points of a node and the measured ranges bound the scores in each subtree; a subtree whose bounds miss
the window is left out with all below it. Leaves are searched exactly: rows of a leaf and the anchors that reach it meet in
blocks of bounded size. The anchor's own leaf is searched first; its k-th best score narrows the window for all other leaves.

The tree decides what is read, never what is found: results are exact. On vectors that are spread evenly in many dimensions few
subtrees can be left out; on clustered ones most are.

Defined results: rows without id, label or vector, with a null or non-finite component, of another length than most, or so long that scores
would not be exact (a squared length beyond 2^53) take no part. Rows with the anchor's id are the anchor's own, never its positives or negatives; anchors that share
an id are one, the least by label and vector. Other repeated rows are candidates of their own. A positive with a score below 0 has an empty window.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotloom.session import stage

# The most rows that a fit reads, children of a node, rows wanted in a leaf, and leaves at most.
FIT_ROWS, FAN, LEAF_ROWS, MOST_LEAVES = 6_000, 8, 2_000, 512
BLOCK_ROWS, BLOCK_QUERIES = 16_000, 1_000
LONGEST = float(1 << 53)
_FAR = 1 << 60


@dataclass
class Tree:
    """Split points of each node, and where its children lead: to a node, or to leaf c if it says -1 - c."""

    points: list[np.ndarray]
    children: list[np.ndarray]
    leaves: int
    # measured over all rows, per node: distances [point, child] and squared lengths [child]
    near: list[np.ndarray] | None = None
    far: list[np.ndarray] | None = None
    least: list[np.ndarray] | None = None
    most: list[np.ndarray] | None = None


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (points * points).sum(1)[None] - 2 * x @ points.T, 0))


def _spread(x: np.ndarray, m: int, rng: np.random.Generator) -> np.ndarray:
    """m of some drawn rows, each the farthest from those before; fewer if rows are equal."""
    drawn = x[rng.permutation(len(x))[:3 * m]]
    chosen, gap = [0], distances(drawn, drawn[:1])[:, 0]
    while len(chosen) < min(m, len(drawn)):
        at = int(gap.argmax())
        if gap[at] <= 1e-6:
            break
        chosen.append(at)
        gap = np.minimum(gap, distances(drawn, drawn[at:at + 1])[:, 0])
    return drawn[chosen]


def grow(sample: np.ndarray, leaves: int, fan: int = FAN) -> Tree:
    """A tree of about so many leaves."""
    tree, rng = Tree([], [], 0), np.random.default_rng(0)
    least = max(fan, len(sample) // max(1, leaves))

    def node(x: np.ndarray) -> int:
        points = _spread(x, fan, rng)
        at = len(tree.points)
        tree.points.append(points)
        tree.children.append(np.zeros(len(points), np.int64))
        side = distances(x, points).argmin(1)
        for j in range(len(points)):
            below = x[side == j]
            if len(points) > 1 and len(below) > 2 * least and tree.leaves + fan < MOST_LEAVES:
                tree.children[at][j] = node(below)
            else:
                tree.children[at][j] = -1 - tree.leaves
                tree.leaves += 1
        return at

    node(sample)
    return tree


def descend(tree: Tree, x: np.ndarray):
    """Yields (node, rows at it, distances to its points, child taken) from the root on."""
    turn = [(0, np.arange(len(x)))]
    while turn:
        node, rows = turn.pop()
        d = distances(x[rows], tree.points[node])
        side = d.argmin(1)
        yield node, rows, d, side
        for j, to in enumerate(tree.children[node].tolist()):
            if to >= 0 and (side == j).any():
                turn.append((to, rows[side == j]))


def leaf_of(tree: Tree, x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), np.int64)
    for node, rows, _, side in descend(tree, x):
        to = tree.children[node][side]
        out[rows[to < 0]] = -1 - to[to < 0]
    return out


def reach(tree: Tree, q: np.ndarray, low: np.ndarray, high: np.ndarray):
    """(query, leaf) of all leaves that may hold a row with a score between ``low`` and ``high``."""
    queries, leaves = [], []
    length = (q * q).sum(1)
    turn = [(0, np.arange(len(q)))]
    while turn:
        node, rows = turn.pop()
        d = distances(q[rows], tree.points[node])
        slack = 1e-6 * (1 + d)
        for j, to in enumerate(tree.children[node].tolist()):
            near, far = tree.near[node][:, j], tree.far[node][:, j]
            if not np.isfinite(far).all():
                continue  # no rows below
            closest = np.maximum(np.maximum(near[None] - d, d - far[None]) - slack, 0).max(1)
            farthest = (d + far[None] + slack).min(1)
            above = (length[rows] + tree.most[node][j] - closest ** 2) / 2 + 1
            below = (length[rows] + tree.least[node][j] - farthest ** 2) / 2 - 1
            some = rows[(above >= low[rows]) & (below <= high[rows])]
            if to >= 0 and len(some):
                turn.append((to, some))
            elif len(some):
                queries.append(some)
                leaves.append(np.full(len(some), -1 - to))
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (queries, leaves))


def _ranges(tree: Tree):
    def measure(batches):
        for batch in batches:
            x, out = _matrix(batch.column("v")), []
            length = (x * x).sum(1)
            for node, rows, d, side in descend(tree, x):
                for j in np.unique(side).tolist():
                    own = side == j
                    for i, (a, b) in enumerate(zip(d[own].min(0).tolist(), d[own].max(0).tolist())):
                        out.append((node, i, j, a, b, float(length[rows[own]].min()), float(length[rows[own]].max())))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n < 3 else pa.float64()) for n, c in enumerate(zip(*out))], list("nijabcd"))
    return measure


def measured(tree: Tree, index: DataFrame) -> Tree:
    """The tree with its ranges over all rows."""
    shape = [(len(p), len(p)) for p in tree.points]
    near, far = [np.full(s, np.inf) for s in shape], [np.full(s, np.inf) for s in shape]
    least, most = [np.full(s[0], np.inf) for s in shape], [np.full(s[0], -np.inf) for s in shape]
    found = index.select("v").mapInArrow(_ranges(tree), "n int, i int, j int, a double, b double, c double, d double").groupBy("n", "i", "j").agg(
        F.min("a").alias("a"), F.max("b").alias("b"), F.min("c").alias("c"), F.max("d").alias("d"))
    for r in found.collect():  # at most FAN rows a child, and the leaves are bounded
        near[r.n][r.i, r.j], far[r.n][r.i, r.j], least[r.n][r.j], most[r.n][r.j] = r.a, r.b, r.c, r.d
    return Tree(tree.points, tree.children, tree.leaves, near, far, least, most)


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, 0))
    return column.cast(pa.large_list(pa.float64())).flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _whole(size: int, scale: float):
    """Rows that take part, scaled."""
    def clean(batches):
        for batch in batches:
            column = batch.column("v").cast(pa.large_list(pa.float64()))
            sizes = np.diff(column.offsets.to_numpy())
            kept = batch.filter(pa.array(sizes == size))
            x = _matrix(kept.column("v"))
            if len(x):
                x = np.floor(scale * x)
                good = np.isfinite(x).all(1)
                good[good] &= (x[good] ** 2).sum(1) <= LONGEST
                v = pa.ListArray.from_arrays(pa.array(np.arange(int(good.sum()) + 1) * size, pa.int32()), pa.array(x[good].reshape(-1)))
                kept = kept.filter(pa.array(good))
                yield pa.RecordBatch.from_arrays([kept.column("id"), kept.column("label"), kept.column("anchor"), v], ["id", "label", "anchor", "v"])
    return clean


def _block_search(k: int, same: bool):
    """The k best rows of a block for each query: of its label or of others, within its window."""
    def search(rows: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows and asked.num_rows:
            ids, labels, x = rows.column("id").to_numpy(), np.array(rows.column("label").to_pylist(), object), _matrix(rows.column("v"))
            codes = {c: i for i, c in enumerate(set(labels.tolist()))}
            label = np.array([codes[c] for c in labels.tolist()])
            wanted = np.array([codes.get(c, -1) for c in asked.column("label").to_pylist()])
            names = ("anchor", "place", "low", "high")
            anchor, place, low, high = (asked.column(c).to_numpy() for c in names)
            q = _matrix(asked.column("v"))
            for start in range(0, len(q), 256):
                part = slice(start, start + 256)
                scores = q[part] @ x.T  # whole numbers below 2^53, so exact
                good = (scores >= low[part, None]) & (scores <= high[part, None]) & (ids[None] != anchor[part, None])
                good &= (label[None] == wanted[part, None]) == same
                scores[~good] = -np.inf
                last = np.partition(scores, len(x) - k, axis=1)[:, len(x) - k] if len(x) > k else np.full(len(scores), -np.inf)
                at, row = np.nonzero(good & (scores >= last[:, None]))
                s = scores[at, row]
                order = np.lexsort((ids[row], -s, at))
                at, row, s = at[order], row[order], s[order]
                top = np.arange(len(at)) - np.searchsorted(at, at) < k
                out.append((anchor[start + at[top]], place[start + at[top]], ids[row[top]], s[top].astype(np.int64)))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 4
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64())],
                        names=["anchor", "place", "id", "score"])
    return search


class _Leaves:
    """The rows by leaf, and searches among them."""

    def __init__(self, index: DataFrame, tree: Tree):
        self.tree, self.rows = tree, index.select("leaf", "id", "label", "v")
        self.row_blocks = self._blocks(index, BLOCK_ROWS)

    def _blocks(self, table: DataFrame, most: int):
        n = np.zeros(max(1, self.tree.leaves), np.int64)
        for r in table.groupBy("leaf").count().collect():  # a row per leaf
            n[r["leaf"]] = -(-r["count"] // most)
        return F.element_at(F.lit(np.maximum(n, 1).tolist()), F.col("leaf") + 1)

    def search(self, asked: DataFrame, k: int, same: bool) -> DataFrame:
        """anchor, place, id, score: the k best of each block, to be merged. ``asked``: anchor, place, label, v, low, high, leaf."""
        asked = stage(asked, "asked")
        query_blocks = self._blocks(asked, BLOCK_QUERIES)
        # repeated rows spread as well: their block is drawn, not hashed from their values
        rows = self.rows.withColumn("row_block", F.floor(F.rand(7) * self.row_blocks)).withColumn(
            "query_block", F.explode(F.sequence(F.lit(0).cast("long"), query_blocks - 1)))
        asked = asked.withColumn("query_block", F.pmod(F.xxhash64("anchor", "place"), query_blocks)).withColumn(
            "row_block", F.explode(F.sequence(F.lit(0).cast("long"), self.row_blocks - 1)))
        names = ["leaf", "row_block", "query_block"]
        return rows.groupBy(*names).cogroup(asked.groupBy(*names)).applyInArrow(_block_search(k, same), "anchor long, place int, id long, score long")

    def routed(self, queries: DataFrame) -> DataFrame:
        """A row for each leaf that may hold a row of the query's window, but for the leaf ``own``, which was searched."""
        tree = self.tree

        def run(batches):
            for batch in batches:
                low, high = (batch.column(c).to_numpy().astype(np.float64) for c in ("low", "high"))
                at, leaf = reach(tree, _matrix(batch.column("v")), low, high) if batch.num_rows else (np.zeros(0, np.int64),) * 2
                other = leaf != batch.column("own").to_numpy()[at]
                at = pa.array(at[other])
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in names), pa.array(leaf[other], pa.int32())], [*names, "leaf"])

        names = ["anchor", "place", "label", "v", "low", "high"]
        kinds = {f.name: f.dataType.simpleString() for f in queries.schema}
        return queries.select(*names, "own").mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in names) + ", leaf int")

    def best(self, queries: DataFrame, k: int, same: bool) -> DataFrame:
        """anchor, place, id, score, rank: the k best of each query. ``queries``: anchor, place, label, v, low, high, own (its leaf)."""
        order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id")
        top = lambda found: found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        first = stage(top(self.search(queries.withColumn("leaf", F.col("own")), k, same)).drop("rank"), "own_leaf")
        reached = first.groupBy("anchor", "place").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") == k)
        narrow = queries.join(reached, ["anchor", "place"], "left").withColumn("low", F.greatest("low", "least")).drop("n", "least")
        return stage(top(first.unionByName(self.search(self.routed(narrow), k, same))), "best")


def hard_negatives(
    table: DataFrame, anchors, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    key: str = "vec_id", label: str = "label", vector: str = "embedding", scale: float = 256.0,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score. ``anchors``: a condition on ``table``."""
    rows = table.select(
        F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{label}`").alias("label"), F.coalesce(anchors, F.lit(False)).alias("anchor"),
        F.col(f"`{vector}`").cast("array<double>").alias("v"))
    rows = rows.where("id is not null and label is not null and v is not null").where(~F.exists("v", lambda c: c.isNull()))
    kind = rows.schema["label"].dataType.simpleString()
    empty = table.sparkSession.createDataFrame(
        [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    sizes = rows.where(F.size("v") > 0).groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    if sizes is None:
        return empty
    rows = stage(rows.mapInArrow(_whole(sizes["size"], scale), f"id long, label {kind}, anchor boolean, v array<double>"), "vectors")
    n = rows.count()
    if not n:
        return empty
    share = int(min(1.0, FIT_ROWS / n) * (1 << 30))
    drawn = rows.where(F.pmod(F.xxhash64("id", F.lit("fit")), F.lit(1 << 30)) < share).orderBy("id").limit(2 * FIT_ROWS).select("v").toArrow()
    sample = _matrix(drawn.column("v"))
    tree = grow(sample if len(sample) else np.zeros((1, sizes["size"])), max(1, min(MOST_LEAVES, -(-n // LEAF_ROWS))))

    def place(batches):
        for batch in batches:
            yield batch.append_column("leaf", pa.array(leaf_of(tree, _matrix(batch.column("v"))), pa.int32())) if batch.num_rows else batch.append_column(
                "leaf", pa.array([], pa.int32()))

    index = stage(rows.mapInArrow(place, f"id long, label {kind}, anchor boolean, v array<double>, leaf int"), "index")
    leaves = _Leaves(index, measured(tree, index))
    own = stage(index.where("anchor").groupBy("id").agg(F.min(F.struct("label", "v", "leaf")).alias("row")).select(
        F.col("id").alias("anchor"), "row.label", "row.v", F.col("row.leaf").alias("own")), "anchors")
    found = leaves.best(own.select("*", F.lit(0).alias("place"), F.lit(-_FAR).alias("low"), F.lit(_FAR).alias("high")), positives, True)
    found = found.select("anchor", F.col("rank").cast("int").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    # low * p <= 100 s <= high * p, for whole s
    windows = found.where("positive_score >= 0").join(own, "anchor").withColumn(
        "low", F.expr(f"({low} * positive_score + 99) div 100")).withColumn("high", F.expr(f"({high} * positive_score) div 100"))
    out = leaves.best(windows.select("anchor", "place", "label", "v", "low", "high", "own"), negatives, False)
    return out.withColumnRenamed("rank", "_rank").join(found, ["anchor", "place"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", F.col("_rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
