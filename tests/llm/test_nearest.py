"""Nearest neighbours: recall and exact scores against brute force, and rows that take no part."""

import numpy as np
from pyspark.sql import functions as F

from slotloom.llm import nearest


def test_balanced_parts_follow_clusters():
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((4, 8)) * 10
    x = np.concatenate([c + rng.standard_normal((100, 8)) for c in centres])[rng.permutation(400)]
    part = nearest.balanced_parts(nearest.neighbours(x, 8), 4)
    assert np.bincount(part).tolist() == [100] * 4
    nearest_centre = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
    assert len({(a, b) for a, b in zip(part, nearest_centre)}) == 4


def test_recall_and_scores(spark):
    rng = np.random.default_rng(1)
    x = (rng.standard_normal((20, 16)) * 3)[rng.integers(0, 20, 3000)] + rng.standard_normal((3000, 16))
    x[700:760] = x[700]  # ties
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(x)]
    rows += [(9001, None, 0), (9000, [0.0] * 16, 0), (9100, [1.0] * 15, 0), (9200, [None] + [1.0] * 15, 0), (9300, [float("nan")] * 16, 0), (None, [1.0] * 16, 0)]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<double>, rank int").repartition(4)
    got = nearest.nearest(df, df.where("vec_id % 50 = 0")).toPandas()
    assert set(got.query_id) == set(range(0, 3000, 50)) and (got.groupby("query_id").size() == 10).all()
    hits = 0
    for q, g in got.groupby("query_id"):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        best = np.lexsort((np.arange(3000), d))[:10]
        g = g.sort_values("rank")
        assert g["rank"].tolist() == list(range(1, 11)) and np.allclose(d[g.vec_id], g.score, atol=1e-12)
        assert sorted(zip(g.score, g.vec_id)) == list(zip(g.score, g.vec_id))
        hits += len(set(best) & set(g.vec_id))
    assert hits / 600 >= 0.9


def test_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [0.0, 2.0]), (100, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = nearest.nearest(df, df.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(0, 1, 100), (0, 2, 1), (0, 3, 1), (100, 1, 0), (100, 2, 1), (100, 3, 1)]
    assert nearest.nearest(df.where(F.lit(False)), df).count() == 0
