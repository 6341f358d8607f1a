"""Text statistics against a brute-force version, and the decision list on planted data."""

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from slotloom.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    rep = {p for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(rep)


TEXTS = [
    None, "", " ", "\n\n", "one", "a\na\n a\na\r\nb\n\n \n \nb", "é é é ü# $|", "x " * 30, "a b c d e f g h " * 5 + "z" * 300,
    "l1 w\nl2 w\nl1 w\n\nl1 w", "no newline at end\nno newline at end", " ".join(map(str, range(500))) + " 1 2 3 4 5 6 7 8 9", "﻿\x1c\x85 q",
]


def test_statistics_against_brute_force(spark):
    rows = [(None if i == 2 else i, t, 1, True) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows + rows[:4], "doc_id int, text string, n_words int, kept boolean").repartition(2)
    got = rules.judge(df, []).collect()
    assert len(got) == len(TEXTS) + 4
    for r in got:
        text = r.row.text
        want = brute(text)
        assert tuple(r[c] for c in rules.COUNTS) == want, text
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert r.kept == (not r.base_failed)
    assert rules.judge(df.where(F.lit(False)), []).count() == 0


def test_learnt_list_and_expression_agree(spark):
    rng = np.random.default_rng(1)
    n = 3000
    data = pd.DataFrame({name: rng.random(n) * 10 for name in rules._measures()})
    low = ((data["symbol_share"] > 7) & (data["word_length"] <= 4)).to_numpy() | (data["repeat_share"] > 9.5).to_numpy()
    found = rules.learn(data, low)
    said = np.zeros(n, bool)
    for rule in found:
        said |= rule.covers(data)
    assert 2 <= len(found) <= 4 and (said == low).mean() > 0.98 and low[said].mean() > 0.97
    assert rules.learn(data, rng.random(n) < 0.1) == []  # noise gives no rule
    frame = spark.createDataFrame(pd.DataFrame({
        "n_words": 100, "word_chars": [100, 900], "n_symbols": [900, 900], "n_repeat_words": 0, "n_dup_lines": 0}))
    rule = rules.Rule((("symbol_share", ">", 7.0), ("word_length", "<=", 4.0)))
    assert [r[0] for r in frame.select(rules.expression([rule])).collect()] == [False, True]


def test_fit_without_labels_or_with_one_class(spark):
    docs = spark.createDataFrame([(1, "a " * 30), (2, "b")], "doc_id int, text string")
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id int, quality int")
    assert rules.fit(docs, labels) == [] and rules.fit(docs, labels.where(F.lit(False))) == []
