"""Near duplicates against all pairs of a small collection."""

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from slotloom.llm import near
from slotloom.llm.words import slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets_of(text):
    w = WORD.findall(text or "")
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute(rows):
    sets = [sets_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    known = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return [known[find(i)] for i in range(len(rows))]


def collection():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(3))
    texts = [None, "", " \n", "one two", "one  two", "one two three", "p q r s t", "x " * 400]
    for _ in range(25):
        base = [word() for _ in range(rng.randint(5, 300))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):  # chains of small edits
            base = list(base)
            for _ in range(max(1, len(base) // 100)):
                base[rng.randrange(len(base))] = word()
            texts.append(" ".join(base))
    texts += texts[10:14]
    return [(100 + (i * 37) % len(texts), t) for i, t in enumerate(texts)] + [(None, texts[9])]


def test_classes_against_all_pairs(spark):
    rows = collection()
    df = spark.createDataFrame([(*r, "k", b"c") for r in rows], "doc_id long, text string, key string, class binary").repartition(3)
    got = near.near_duplicates(df).select("row.doc_id", "row.text", "class_id").collect()
    want = sorted(zip(rows, brute(rows)), key=repr)
    assert sorted((((r.doc_id, r.text), r.class_id) for r in got), key=repr) == want
    kept = near.first_of_each(df).collect()
    wordless = sum(not sets_of(t) for _, t in rows)
    assert len(kept) == len({c for (_, t), c in want if sets_of(t)}) + wordless
    assert all(r.doc_id in {c for _, c in want} for r in kept) and kept[0].asDict().keys() == set(df.columns)
    assert near.near_duplicates(df.where(F.lit(False))).count() == 0


def test_signatures_estimate_probability_jaccard():
    def weighted(text):
        part = next(slices(pa.array([text])))
        values, counts, _, _ = near.shingles(part)
        return values, 1 + np.log(counts)

    rng = random.Random(2)
    for size in (8, 60, 900):
        base = [str(rng.randint(0, 10 ** 6)) for _ in range(size)] + ["a b c d e f"] * 3
        other = base[: size * 9 // 10] + ["q", "r"]
        (a, wa), (b, wb) = weighted(" ".join(base)), weighted(" ".join(other))
        x, y = dict(zip(a.tolist(), wa)), dict(zip(b.tolist(), wb))
        keys = set(x) | set(y)
        want = sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in keys) for i in set(x) & set(y))
        n = 4000
        sa = near.signatures(a, wa, np.zeros(len(a), int), 1, n)
        sb = near.signatures(b, wb, np.zeros(len(b), int), 1, n)
        assert abs((sa == sb).mean() - want) < 4 * (want * (1 - want) / n) ** 0.5 + 0.005
        both = near.signatures(np.concatenate([b, a]), np.concatenate([wb, wa]), np.array([0] * len(b) + [1] * len(a)), 2, n)
        assert (both[1] == sa[0]).all() and (both[0] == sb[0]).all()
