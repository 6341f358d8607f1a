"""Near duplicates whose lines recur very unequally often."""

import random

from slotloom.llm import near
from test_near import brute, sets_of


def uneven_pairs():
    rng = random.Random(5)
    rows = []
    for i in range(14):
        lines = [" ".join(f"w{rng.randrange(10 ** 9)}" for _ in range(60)) for _ in range(10)]
        often = " ".join(" ".join([line] * (100 if at < 3 else 1)) for at, line in enumerate(lines))
        words = " ".join(lines).split()
        once = " ".join(words[:-45] + [f"o{rng.randrange(10 ** 9)}" for _ in range(45)])
        rows += [(2 * i, often), (2 * i + 1, once)]
    return rows


def test_pairs_of_unequal_counts_against_all_pairs(spark):
    rows = uneven_pairs()
    for (_, often), (_, once) in zip(rows[::2], rows[1::2]):
        a, b = sets_of(often), sets_of(once)
        assert 0.8 <= len(a & b) / len(a | b) < 0.9
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.class_id for r in near.near_duplicates(df).select("row.doc_id", "class_id").collect()}
    assert [got[i] for i, _ in rows] == brute(rows) == [i - i % 2 for i, _ in rows]
