"""Hard negatives against all pairs; what the tree leaves out; odd rows."""

import math

import numpy as np
from pyspark.sql import functions as F

from slotloom.llm import mining


def brute(rows, positives=5, negatives=10, low=30, high=90, every=50):
    good = []
    for i, v, label in rows:
        if i is None or label is None or v is None or len(v) != 16 or any(c is None or not math.isfinite(c) for c in v):
            continue
        x = [math.floor(256 * c) for c in v]
        if sum(c * c for c in x) <= 2 ** 53:
            good.append((i, label, x))
    ids, labels, x = np.array([g[0] for g in good]), np.array([g[1] for g in good]), np.array([g[2] for g in good])
    out = []
    for anchor in sorted({i for i in ids.tolist() if i % every == 0}):
        label, v = min((lab, x) for i, lab, x in good if i == anchor)
        scores = x @ np.array(v)
        order = [i for i in np.lexsort((ids, -scores)).tolist() if ids[i] != anchor]
        for p in [i for i in order if labels[i] == label][:positives]:
            found = [i for i in order if labels[i] != label and low * scores[p] <= 100 * scores[i] <= high * scores[p]]
            out += [(anchor, int(ids[p]), r + 1, int(ids[i]), int(scores[p]), int(scores[i])) for r, i in enumerate(found[:negatives])]
    return sorted(out)


def clustered(n=2400):
    rng = np.random.default_rng(3)
    centre = rng.standard_normal((12, 16))
    which = rng.integers(0, 12, n)
    x = centre[which] * 3 + rng.standard_normal((n, 16)) * 0.4
    x[900:1700] = x[900]  # a third of all rows is one vector
    return [(i, v, int(w % 3)) for i, (v, w) in enumerate(zip(x.tolist(), which))]


def odd():
    one = [1.0] * 16
    return [(5000, None, 0), (5050, [None] + one[1:], 0), (5100, [math.nan] + one[1:], 1), (5150, [-math.inf] + one[1:], 1), (5200, one, None),
            (None, one, 1), (5250, one[1:], 1), (5300, [0.0] * 16, 2), (5301, [0.0] * 16, 2), (5302, [0.0] * 16, 0), (5350, [3e38] * 16, 1),
            (100, one, 0), (100, one, 0), (7, one, 1), (7, one, 1)]


SCHEMA = "vec_id long, embedding array<double>, label int"


def mined(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("rank", F.lit(1)).withColumn("leaf", F.lit("x")).repartition(3)
    got = mining.hard_negatives(df, F.col("vec_id") % 50 == 0, **more)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def test_against_all_pairs(spark, monkeypatch):
    rows = clustered() + odd()
    want = brute(rows)
    assert len(want) > 1000
    monkeypatch.setattr(mining, "LEAF_ROWS", 60)
    monkeypatch.setattr(mining, "BLOCK_ROWS", 300)  # the leaf of the common vector is dealt into blocks
    monkeypatch.setattr(mining, "BLOCK_QUERIES", 10)
    assert mined(spark, rows) == want
    assert mined(spark, rows, positives=2, negatives=3, low=50, high=70) == brute(rows, 2, 3, 50, 70)


def test_few_and_no_rows(spark):
    rows = [(0, [1.0] * 16, 0), (1, [0.9] * 16, 0), (2, [0.5] * 16, 1), (3, [0.5] * 16, 2)]
    assert mined(spark, rows) == brute(rows) and len(brute(rows)) == 2
    assert mined(spark, odd()) == brute(odd())
    assert mined(spark, rows[:1]) == [] and mined(spark, []) == [] and mined(spark, [(0, None, 1), (50, [], 1)]) == []


def test_ranges_leave_out_siblings_and_lose_nothing(spark):
    rng = np.random.default_rng(5)
    centre = rng.standard_normal((40, 16)) * 2000
    x = np.floor(centre[rng.integers(0, 40, 4000)] + rng.standard_normal((4000, 16)) * 60)
    tree = mining.grow(x[:1000], 64)
    df = spark.createDataFrame([(v,) for v in x.tolist()], "v array<double>").repartition(3)
    tree = mining.measured(tree, df)
    leaf = mining.leaf_of(tree, x)
    q = x[:50]
    scores = q @ x.T
    own = (q * q).sum(1)
    low, high = np.floor(own * 0.8), np.floor(own * 0.95)
    at, leaves = mining.reach(tree, q, low, high)
    reached = set(zip(at.tolist(), leaves.tolist()))
    for i in range(50):
        inside = np.flatnonzero((scores[i] >= low[i]) & (scores[i] <= high[i]))
        assert {(i, int(c)) for c in leaf[inside]} <= reached
    held = len(np.unique(leaf))
    assert held > 30 and len(reached) < 0.5 * 50 * held
    everything = mining.reach(tree, q, np.full(50, -np.inf), np.full(50, np.inf))
    assert len(everything[0]) == 50 * held
