"""Repeated passages against a brute-force version."""

import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from slotloom.llm.repeats import drop_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts, size):
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i:i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for w in words:
        gone = {p for i in range(len(w) - size + 1) if seen[tuple(w[i:i + size])] > 1 for p in range(i, i + size)}
        kept = " ".join(t for p, t in enumerate(w) if p not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def texts_for_tests():
    rng = random.Random(3)
    word = lambda: rng.choice("abcdefgh") * rng.randint(1, 3)
    passage = [word() for _ in range(20)]
    long_passage = [f"p{i}é" for i in range(90)]
    out = [None, "", "  \t\n ", "one", " ".join(["x"] * 40), " ".join(["x"] * 12), "a b " * 30]
    for i in range(60):
        body = [f"{word()}{i}" for _ in range(rng.randint(0, 60))]
        cut = rng.randint(0, len(body))
        a = rng.randint(0, 8)
        b = rng.randint(12, 20)
        lo = rng.randint(0, 60)
        body[cut:cut] = passage[a:b] + ([" mid"] if i % 3 else []) + long_passage[lo:lo + 30]
        out.append((" " if i % 2 else "\n").join(body))
    return out + [out[20], out[20], out[21] + " end", " ".join(f"w{i % 50}" for i in range(3000))]


def test_against_brute_force(spark):
    texts = texts_for_tests()
    df = spark.createDataFrame([(None if i == 3 else i, t, 7, "k") for i, t in enumerate(texts)], "doc_id int, text string, key int, shard string").repartition(3)
    for size in (12, 35):
        got = drop_repeats(df, size=size).select("row.doc_id", "row.shard", "n_words", "n_removed", "kept_sha256", "kept_text").collect()
        assert len(got) == len(texts)
        want = brute(texts, size)
        for r in got:
            n = 3 if r.doc_id is None else r.doc_id
            assert (r.n_words, r.n_removed, r.kept_sha256) == want[n][:3], (n, texts[n])
            assert r.kept_text == (None if texts[n] is None else want[n][3])


def test_repeated_rows_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(1, text), (1, text), (1, "z")], "doc_id int, text string")
    assert sorted((r.n_words, r.n_removed) for r in drop_repeats(df).collect()) == [(1, 0), (40, 40), (40, 40)]
    assert drop_repeats(df.where(F.lit(False))).count() == 0
