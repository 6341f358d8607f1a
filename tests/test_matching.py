"""Matching within rows: queues against a plain fold, containment and counts against all pairs, long texts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotloom.functions import matching
from slotloom.functions.text import strip_punct, ws_tokens
from slotloom.operators import entities, features, lexicons, scoring, training
from slotloom.sources import report

TEMPLATE = "tmpl_ord long, doc_id string, slot string, val_ord long, value string"


def fold(answers, options):
    left, found = [set(o) for o in options], []
    for a in answers:
        at = next((i for i, o in enumerate(left) if a in o), None)
        found.append(at is not None)
        if at is not None:
            del left[at]
    return found


def test_queues_match_like_the_plain_fold():
    rng = random.Random(1)
    for _ in range(300):
        names = "abcdef"[:rng.randint(1, 6)]
        options = [rng.sample(names, rng.randint(0, len(names))) for _ in range(rng.randint(0, 12))]
        answers = [rng.choice(names + "z") for _ in range(rng.randint(0, 12))]
        assert matching.greedy_flags(answers, options) == fold(answers, options)


def test_ten_thousand_tangled_values(spark):
    """Each gold value shares an alternative with the next one, and all share one."""
    n = 10_000
    gold = [(0, "d", None, None, None)] + [(0, "d", "status", i, f'"v{i}" / "v{i + 1}" / "all"') for i in range(n)]
    resp = [(0, "D", None, None, None)] + [(0, "D", "status", i, '"ALL"' if i % 3 == 0 else f'"v{i}"') for i in range(n)]
    got = scoring.tally(spark.createDataFrame(resp, TEMPLATE), spark.createDataFrame(gold, TEMPLATE)).filter("slot = 'status'").first()
    want = sum(fold([v.lower() for *_, v in resp[1:]], [[o.strip() for o in v.split("/")] for *_, v in gold[1:]]))
    assert (got.correct, got.generated, got.gold) == (want, n, n)


def test_repeated_ids_and_both_pairings(spark):
    """Ids that occur several times pair by occurrence; counts per slot and the report follow the pairs."""
    record = lambda n, i, *values: [(n, i, None, None, None), *((n, i, "seller", k, v) for k, v in enumerate(values))]
    gold = spark.createDataFrame(record(0, "a", '"x"') + record(1, "b") + record(2, "A", '"y"', '"y"') + record(3, "a", '"z"'), TEMPLATE)
    resp = spark.createDataFrame(record(0, "a", '"y"') + record(1, "A", '"Y"', '"y"', '"y"') + record(2, "c", '"z"'), TEMPLATE)
    for by, pairs in (("doc", {0: 0, 2: 1}), ("position", {0: 0})):
        found = scoring.paired(resp, gold, by)
        assert {r.tmpl_ord: r.resp_ord for r in found.collect()} == pairs == {r.tmpl_ord: r.resp_ord for r in scoring.align(resp, gold, by).collect()}
        sellers = {r.tmpl_ord: (r.correct, r.generated, r.gold) for r in scoring.tally(resp, gold, by).filter("slot = 'seller'").collect()}
        assert sellers == {k: v for k, v in {0: (0, 1, 1), 2: (2, 3, 2)}.items() if k in pairs}
    lines = [r.line for r in report.document_report(scoring.paired(resp, gold)).filter("tmpl_ord = 2").orderBy("line_no", "val_ord").collect()]
    assert lines[8:10] == ['SELLER:         "y"', '                "y"'] and "SELLER          1.00 (2/2)\t   0.67 (2/3)         0.80" in lines
    assert scoring.tally(resp.limit(0), gold).count() == 0


def test_scoring_plans_stay_small(spark):
    gold = spark.createDataFrame([(0, "a", None, None, None)], TEMPLATE)
    for df, most in ((scoring.tally(gold, gold), 2), (scoring.tally(gold, gold, "position"), 1), (scoring.greedy_match(gold, gold), 1),
                     (report.document_report(scoring.paired(gold, gold)), 2), (scoring.corpus_scores(scoring.tally(gold, gold)), 3)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert sum(line.split("Exchange")[0].strip(" +-:*") == "" for line in plan.splitlines() if "Exchange" in line) <= most


def test_containment_against_all_pairs(spark):
    rng = random.Random(2)
    texts = [(rng.randrange(6), "".join(rng.choice("ab é") for _ in range(rng.randint(0, 9)))) for _ in range(240)] + [(1, None), (None, "a")]
    needles = [(k, t) for k, t in texts[::2]] + [(9, "a")]
    outer = spark.createDataFrame(texts, "doc_id int, o_text string").withColumn("o", F.lit(1))
    inner = spark.createDataFrame(needles, "doc_id int, needle string").withColumn("i", F.lit(2))
    got = sorted((r.doc_id, r.o_text, r.needle) for r in entities.containments(outer, inner, ["doc_id"]).collect())
    assert got == sorted((k, t, n) for k, t in texts for j, n in needles if k is not None and k == j and t is not None and n is not None and n in t)


def test_containment_in_a_very_long_run(spark):
    run = "x" * 20_000
    rows = [(1, 0, run, "ORG", 0, 1), (1, 1, run[:9_999], "ORG", 0, 1), (1, 2, "x", "ORG", 0, 1), (1, 3, "y", "ORG", 0, 1), (2, 0, "x", "ORG", 0, 1)]
    ents = spark.createDataFrame(rows, "doc_id int, ord int, text string, label string, start int, end int")
    got = {(r.doc_id, r.ord): r.refers_to for r in entities.mark_references(ents).collect()}
    assert got == {(1, 0): None, (1, 1): run, (1, 2): run, (1, 3): None, (2, 0): None}


def test_nested_sets_against_all_pairs():
    rng = random.Random(3)
    for _ in range(60):
        left, right = ([rng.sample("abcdefg", rng.randint(0, 4)) for _ in range(15)] for _ in range(2))
        got = sorted(matching.nested(left, right))
        assert got == sorted((i, j) for i, a in enumerate(left) for j, b in enumerate(right) if not b or a and (set(a) <= set(b) or set(b) <= set(a)))


def test_overlaps_of_a_long_document(spark):
    """20,000 words with one word in every chunk: pairs follow the result, not chunks times gold texts."""
    n = 10_000
    chunks = [(1, 0, i, f"the w{i}") for i in range(n)]
    gold = [(1, f"the, w{i} inc", "seller", i) for i in range(0, n, 5)] + [(1, "the absent", "status", 1), (2, "the", "status", 0)]
    c = spark.createDataFrame(chunks, "doc_id int, sent_idx int, ord int, text string")
    g = spark.createDataFrame(gold, "doc_id int, text string, slot string, place int")
    got = training.overlaps(c, g)
    assert sorted((r.ord, r.gold_text) for r in got.collect()) == [(i, f"the, w{i} inc") for i in range(0, n, 5)]
    few_c, few_g = c.filter("ord < 40"), g.filter("place < 40")
    held = few_c.join(few_g.withColumnRenamed("text", "gold_text"), "doc_id").select(
        "ord", "gold_text", ws_tokens(F.col("text")).alias("c"), F.transform(ws_tokens(F.col("gold_text")), strip_punct).alias("g")).collect()
    want = sorted((r.ord, r.gold_text) for r in held if set(r.c) <= set(r.g) or set(r.g) <= set(r.c))
    assert sorted((r.ord, r.gold_text) for r in training.overlaps(few_c, few_g).collect()) == want


def test_occurrences_do_not_overlap(spark):
    rng = random.Random(4)
    for _ in range(100):
        text = "".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))
        needles = list({"".join(rng.choice("ab") for _ in range(rng.randint(0, 5))) for _ in range(8)})
        assert matching.occurrences(text, needles) == [text.count(n) for n in needles]
    docs = spark.createDataFrame([(1, "aaaa banana é😀é"), (2, "x")], "doc_id int, text string")
    texts = spark.createDataFrame([(1, "aa"), (1, "aa"), (1, "ana"), (1, "é"), (1, ""), (2, "y"), (3, "z")], "doc_id int, text string")
    got = {(r.doc_id, r.text): r.freq for r in features.frequencies_in(texts, docs).collect()}
    assert got == {(1, "aa"): 2, (1, "ana"): 1, (1, "é"): 2, (1, ""): 16, (2, "y"): 0}


def _plain_spans(words, phrases):
    return sorted((i, len(p), " ".join(p)) for p in phrases for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p)


@pytest.mark.parametrize("limit", [0, 1000])
def test_phrase_spans_of_any_length(spark, limit):
    draw = random.Random(8)
    words = [draw.choice("ab") for _ in range(1500)] + [f"w{i}" for i in range(300)]
    phrases = [["a"], ["a", "b", "a"], words[40:240], words[1480:1800], ["zz"]]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, None), (3, ""), (4, "a")], "doc_id int, text string")
    table = spark.createDataFrame([(i, " ".join(p)) for i, p in enumerate(phrases)] + [(9, ""), (10, None), (11, "a")], "phrase_ord int, phrase string")
    got = lexicons.phrase_spans(docs, table, limit).collect()
    assert sorted((r.tok_idx, r.n_tok, r.text) for r in got if r.doc_id == 1) == _plain_spans(words, phrases)
    assert [(r.doc_id, r.tok_idx) for r in got if r.doc_id != 1] == [(4, 0)]


def test_phrase_plan_does_not_grow_with_the_phrases(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id int, text string")
    sizes = []
    for n in (2, 200):
        table = spark.createDataFrame([(0, " ".join(["a"] * n))], "phrase_ord int, phrase string")
        plan = lexicons.phrase_spans(docs, table, 0)._jdf.queryExecution().optimizedPlan().toString()
        sizes.append(len(plan.splitlines()))
    assert sizes[0] == sizes[1]


def test_window_hashes_equal_for_equal_windows():
    draw = random.Random(3)
    words = np.array([draw.randrange(4) for _ in range(400)], np.uint64) * np.uint64(0x123456789ABCDEF1)
    for n, hashes in matching.window_hashes(words, [1, 3, 7, 500]):
        assert n < 500 and len(hashes) == len(words) - n + 1
        seen = {}
        for i, h in enumerate(hashes.tolist()):
            assert seen.setdefault(h, tuple(words[i:i + n])) == tuple(words[i:i + n])
        assert len(seen) == len({tuple(words[i:i + n]) for i in range(len(hashes))})


def test_a_measured_lexicon_moves_no_text(spark):
    texts = spark.createDataFrame([(1, "abcd abcde x"), (2, "bcde"), (3, ""), (4, None)], "id int, text string")
    lexicon = spark.createDataFrame([(0, "abcd"), (1, "bcde"), (2, "d"), (3, ""), (4, None), (5, "zzzz")], "lex_ord long, status string")
    found = [sorted(map(tuple, lexicons._joined_hits(texts, ["id"], lexicon, small).collect())) for small in (0, 1 << 20)]
    assert found[0] == found[1] == [(1, 0, "abcd"), (1, 1, "bcde"), (1, 2, "d"), (1, 3, ""), (2, 1, "bcde"), (2, 2, "d"), (2, 3, ""), (3, 3, "")]
    plan = lexicons._joined_hits(texts, ["id"], lexicon)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(id" not in plan and "SortMergeJoin [id" not in plan


def test_measured_phrases_move_no_window(spark):
    docs = spark.createDataFrame([(1, "a b a c"), (2, "c"), (3, None)], "doc_id int, text string")
    table = spark.createDataFrame([(0, "a b"), (1, "a"), (2, "c"), (3, "q r")], "phrase_ord int, phrase string")
    ways = [lexicons.phrase_spans(docs, table, 0, small) for small in (0, 1 << 20)]
    rows = [sorted(map(tuple, way.select("doc_id", "tok_idx", "n_tok", "text").collect())) for way in ways]
    assert rows[0] == rows[1] == [(1, 0, 1, "a"), (1, 0, 2, "a b"), (1, 2, 1, "a"), (1, 3, 1, "c"), (2, 0, 1, "c")]
    assert "Exchange hashpartitioning(doc_id" not in ways[1]._jdf.queryExecution().executedPlan().toString()
