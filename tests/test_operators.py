"""Operators against plain Python on small inputs."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotloom.functions import text as fx
from slotloom.functions.trees import nearest_sources
from slotloom.operators import annotate, entities, lexicons, model, training


def test_running_total(spark):
    for n in (0, 1, 255, 256, 257, 700):
        df = spark.createDataFrame([(list(range(n)),)], "a array<int>")
        got = df.select(fx.running_total(F.col("a"), block=256).alias("t")).first().t
        assert got == list(np.cumsum(range(n))) if n else got == []


def test_word_ranks_and_window(spark):
    sents = ["the cat  sat on mats", "one", " lead in", "sat sat", "élan vital é"]
    phrases = ["the", "sat", "at", "mats", "on mats", "zzz", "é", "one", "ats"]
    rows = list(itertools.product(sents, phrases))
    df = spark.createDataFrame(rows, "s string, p string").select(
        "s", "p", fx.ranked_loc(F.col("p"), F.col("s"), fx.word_ranks(F.col("s"))).alias("loc"),
    ).withColumn("w", fx.context_window(F.col("loc"), fx.ws_tokens(F.col("s"))))
    for r in df.collect():
        at = r.s.find(r.p)
        a = len(r.s[:at].split()) if at >= 0 else -1
        b = a + len(r.p.split()) if at >= 0 else -1
        assert (r.loc.a, r.loc.b) == (a, b), r
        words = r.s.split()
        before = ["phi2", "phi1"] if a < 1 else ["phi1", words[0]] if a == 1 else words[a - 2:a]
        after = (words[b:b + 2] + ["omega1", "omega2"])[:2] if 0 <= b < len(words) else ["omega1", "omega2"]
        assert r.w == before + after, r


def test_text_rules(spark):
    df = spark.createDataFrame([("theX", "83.5", "  a b\t"), ("the Co", "a1", "")], "a string, n string, t string")
    got = df.select(
        fx.strip_article(F.col("a")).alias("cut"), fx.strip_article(F.col("a"), False).alias("word"),
        fx.is_number(F.col("n")).alias("num"), fx.strip(F.col("t")).alias("t"), fx.frequency(F.col("t"), F.col("a")).alias("f"),
    ).collect()
    assert [tuple(r) for r in got] == [("X", "theX", True, "a b", 0), (" Co", " Co", False, "", 7)]


def test_sentences(spark):
    text = "Blue Corp. bought U.S. Mills Inc. for 3.5 mln dlrs. It paid! Why? Last one."
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    got = [r.sent for r in annotate.sentences(docs).orderBy("sent_idx").collect()]
    assert got == ["Blue Corp. bought U.S. Mills Inc. for 3.5 mln dlrs.", "It paid!", "Why?"]


def _brute_in_order(texts):
    marked, refers, referred = set(), {}, {}
    for outer in texts:
        for inner in texts:
            if outer == inner or outer in marked:
                continue
            if inner.strip().strip("'s") in outer:
                referred[outer], refers[inner] = inner, outer
                marked.add(inner)
    return {t: (refers.get(t), referred.get(t), t in marked) for t in texts}


def test_references_in_order(spark):
    rng = random.Random(7)
    groups = [["IBM's", "IBM", "IBM Corp"], ["s", "a", "b s"], ["abc", "ab", "b", "a'"]]
    for _ in range(60):
        words = {"".join(rng.choice("ab's ") for _ in range(rng.randint(1, 5))).strip() for _ in range(6)} - {""}
        groups.append(sorted(words, key=lambda w: rng.random()))
    rows = [(d, 0, i, t, "ORG", 0, 0) for d, g in enumerate(groups) for i, t in enumerate(g)]
    ents = spark.createDataFrame(rows, "doc_id int, sent_idx int, ord int, text string, label string, start int, end int")
    got = entities.mark_references_in_order(ents).collect()
    want = {(d, t): v for d, g in enumerate(groups) for t, v in _brute_in_order(g).items()}
    assert {(r.doc_id, r.text): (r.refers_to, r.referred_by, r.is_reference) for r in got} == want


def test_merge_locations(spark):
    sent = "in Oslo, Viken, Norway and far away Rome"
    rows = [(1, 0, i, t, "GPE", sent.index(t), sent.index(t) + len(t)) for i, t in enumerate(["Oslo", "Viken", "Norway", "Rome"])]
    ents = spark.createDataFrame(rows, "doc_id int, sent_idx int, ord int, text string, label string, start int, end int")
    sents = spark.createDataFrame([(1, 0, sent)], "doc_id int, sent_idx int, sent string")
    got = {(r.text, r.label) for r in entities.merge_locations(ents, sents).collect()}
    assert got == {("Oslo, Viken, Norway", "LOC"), ("Rome", "GPE")}


def test_lexicon_paths_agree(spark):
    rng = random.Random(3)
    sents = [(i, 0, "".join(rng.choice("abé ") for _ in range(rng.randint(0, 30)))) for i in range(80)]
    words = sorted({"".join(rng.choice("abé ") for _ in range(rng.randint(1, 6))) for _ in range(60)})
    df = spark.createDataFrame(sents, "doc_id int, sent_idx int, sent string")
    words += ["", words[0], words[-1]]  # an empty phrase is in every text; repeated phrases hit each
    lex = spark.createDataFrame(list(enumerate(words)), "lex_ord long, status string")
    want = sorted((d, i, w) for d, _, s in sents for i, w in enumerate(words) if w in s)
    for limit in (1000, 0):
        assert sorted((r.doc_id, r.lex_ord, r.status) for r in lexicons.lexicon_hits(df, lex, limit).collect()) == want


def test_undisclosed_phrases(spark):
    docs = spark.createDataFrame([(1, "for an undisclosed amount, terms not disclosed.")], "doc_id int, text string")
    assert sorted(r.text for r in lexicons.phrase_spans(docs).collect()) == ["not disclosed", "undisclosed", "undisclosed amount"]


def test_nearest_sources():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randint(1, 12)
        parent = np.array([i if rng.random() < 0.2 else rng.randrange(i) if i else 0 for i in range(n)])
        perm = np.array(rng.sample(range(n), n))
        parent = np.array([perm[parent[np.where(perm == i)[0][0]]] for i in range(n)])
        source = np.array([rng.random() < 0.4 for _ in range(n)])
        got = nearest_sources(parent, source)
        near = [{j for j in range(n) if j != i and (parent[i] == j or parent[j] == i)} for i in range(n)]
        for t in range(n):
            dist, todo = {t: 0}, [t]
            for x in todo:
                for y in near[x]:
                    if y not in dist:
                        dist[y] = dist[x] + 1
                        todo.append(y)
            best = min(((d, v) for v, d in dist.items() if source[v] and v != t), default=(0, -1))[1]
            assert got[t] == best


def test_balance(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 10 == 0, "status").otherwise("none").alias("label"))
    got = training.balance_negatives(rows, ["id"])
    assert {r.label: r["count"] for r in got.groupBy("label").count().collect()} == {"status": 300, "none": 300}
    with pytest.raises(Exception, match="fewer rows"):
        training.balance_negatives(rows.filter("id % 10 < 1 OR id < 50"), ["id"]).collect()


def test_pick_slot_ties(spark):
    rows = [("d", "seller", 0, "x", "seller", 0.5), ("d", "seller", 1, "y", "seller", 0.5), ("d", "status", 0, "z", "none", 0.9)]
    scored = spark.createDataFrame(rows, "doc_id string, slot string, cand_idx int, text string, prediction string, score double")
    docs = spark.createDataFrame([("d",)], "doc_id string")
    got = {r.slot: r.text for r in model.pick_slot(scored, docs).collect()}
    assert got["seller"] == "y" and got["status"] is None and len(got) == 7


def test_empty_and_uncovered_texts_find_a_token(spark):
    from slotloom.operators import annotate, entities

    sents = spark.createDataFrame([(1, 0, "Red Fox bought it today")], "doc_id long, sent_idx int, sent string")
    arrays = annotate.annotate(sents)
    tokens = annotate.token_rows(arrays)
    texts = spark.createDataFrame([(1, 0, t) for t in ("", "bought", "Red ", "absent")], "doc_id long, sent_idx int, text string")
    chunks = annotate.noun_chunks(arrays).limit(0)

    def found(compat):
        rows = entities.match_to_chunk(texts, chunks, tokens, sents, compat).collect()
        return {r.text: (r.anchor, r.root_idx) for r in rows}

    assert found(True) == {"": ("today", 4), "bought": ("bought", 2), "Red ": ("Red", 0), "absent": ("Red", 0)}
    assert found(False) == {"": ("Red", 0), "bought": ("bought", 2), "Red ": ("Red", 0), "absent": ("Red", 0)}


def test_heads_reach_over_long_sentences(spark):
    from slotloom.operators import annotate

    words = ["said", *["stone"] * 400, "bought", *["stone"] * 400]
    sents = spark.createDataFrame([(1, 0, " ".join(words))], "doc_id long, sent_idx int, sent string")
    heads = [t.head_idx for t in annotate.annotate(sents).first().toks]
    assert heads == [0] * 402 + [401] * 400


def test_gold_and_overlaps_are_made_once(spark, monkeypatch):
    from slotloom.plans.catalog import inputs
    from slotloom.plans.catalog import training as queries

    folder, made = "/root/testdata/sf0.001", []

    def counted(module, name):
        real = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *args, **named: made.append(name) or real(*args, **named))

    monkeypatch.setattr(inputs, "_STAGED", {})
    counted(queries, "sent_phrase")
    counted(training, "stage")
    counted(inputs, "sentences")
    whole = queries.l4_inject_gold_by_offset(spark, folder)
    # the sentences are cut for the annotation alone, which all sides read
    assert made == ["sent_phrase", "sentences"] or made == ["sentences", "sent_phrase"]
    assert whole.count() > 0
    queries.l_training_rows(spark, folder)
    assert made.count("sent_phrase") == 1 and made.count("stage") == 2 and made.count("sentences") == 2  # the other: whole documents
