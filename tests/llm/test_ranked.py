"""Ranked search against brute force; early ends of reading; odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from slotloom.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for doc, c in counted:
            m = 25 + 75 * sum(c.values()) * n // total
            scores.append((-sum(
                times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                for t, times in Counter(terms(text)).items() if t in c), doc is None, doc or 0))
        best = sorted(s for s in scores if s[0] < 0)[:k]
        out += [(item, r + 1, None if gone else doc, -s) for r, (s, gone, doc) in enumerate(best)]
    return sorted(out, key=repr)


def collection():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["Été", "ΣΑΣ", "it's", "A_b", "42", "x\u0085y", "the"]
    draw = lambda n: " ".join(words[min(int(rng.expovariate(0.06)), len(words) - 1)] for _ in range(n))
    docs = [(i * 7 % 300, draw(rng.choice([1, 3, 20, 90]))) for i in range(300)]
    docs += [(400, None), (401, ""), (402, "?! \n"), (403, draw(20_000)), (None, "w3 w4 w5"), (404, "w3 w4 w5"), (405, "w3 w4 w5")]
    docs += [(500, "the w7 w9 same row")] * 160  # a third of all rows
    items = [(i, draw(rng.randint(1, 40))) for i in range(40)] + [(90, None), (91, ""), (92, "absent"), (93, "W3 w3 W4"), (93, "W3 w3 W4"), (93, "same row")]
    return docs, items


def test_against_brute_force(spark):
    docs, items = collection()
    df = spark.createDataFrame([(*d, "k", 1) for d in docs], "doc_id int, text string, item string, score int").repartition(5)
    asked = spark.createDataFrame([(*i, 2) for i in items], "item_id int, text string, rank int")
    want = brute(docs, items)
    for sizes in ({}, {"shard_postings": 300, "block_bytes": 400}):  # one shard a task; many shards, and items in blocks
        got = ranked.search(df, asked, **sizes)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    assert sorted((tuple(r) for r in ranked.search(df, asked, k=1000).collect()), key=repr) == brute(docs, items, 1000)
    assert ranked.search(df.where(F.lit(False)), asked).count() == 0 == ranked.search(df, asked.where(F.lit(False))).count()


def test_reading_ends_when_all_is_resolved():
    rng = np.random.default_rng(0)
    n = 5000
    # three documents lead every list; no other can reach them
    lists = [(np.concatenate([[5, 6, 7], rng.permutation(np.arange(8, n))]), np.concatenate([[900, 890, 880], np.sort(rng.integers(1, 100, n - 8))[::-1]])) for _ in range(4)]
    found, scores, read = ranked.nra(lists, n, 3)
    assert found.tolist() == [5, 6, 7] and scores.tolist() == [3600, 3560, 3520] and read < 20
    # ties at the k-th place are all returned, with final scores
    flat = [(np.arange(n), np.full(n, 50)), (np.array([3, 9]), np.array([60, 1]))]
    found, scores, _ = ranked.nra(flat, n, 2)
    assert found.tolist() == [3, 9] and scores.tolist() == [110, 51]
    found, scores, _ = ranked.nra(flat[:1], n, 2)
    assert len(found) == n and set(scores.tolist()) == {50}
    # a score to reach from elsewhere ends the reading earlier
    assert ranked.nra(lists, n, 3, floor=10_000)[2] < 20 and len(ranked.nra(lists, n, 3, floor=10_000)[0]) == 0
    assert len(ranked.nra([(np.zeros(0, int), np.zeros(0, int))], 4, 2)[0]) == 0


def test_intervals_hold_at_random():
    rng = np.random.default_rng(1)
    for turn in range(60):
        n, k = int(rng.integers(1, 40)), int(rng.integers(1, 6))
        lists, total = [], np.zeros(n, np.int64)
        for _ in range(int(rng.integers(1, 6))):
            docs = rng.permutation(n)[:rng.integers(1, n + 1)]
            gains = np.sort(rng.integers(1, 8 if turn % 2 else 1000, len(docs)))[::-1]
            total[docs] += gains
            lists.append((docs, gains))
        found, scores, _ = ranked.nra(lists, n, k)
        least = max(1, np.sort(total)[::-1][min(k, n) - 1]) if n >= k else 1
        assert sorted(found) == np.flatnonzero(total >= least).tolist() and (scores == total[found]).all()
