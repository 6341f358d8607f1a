"""Steps that many queries share look at each text once, and at no more of it than they need."""

import random

from pyspark.sql import functions as F

from slotloom.functions import text as fx
from slotloom.operators import annotate, lexicons
from slotloom.plans.catalog import inputs


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_word_ranks_by_words(spark):
    draw = random.Random(3)
    rows = [("".join(draw.choice("ab \t.\U0001f600\n\x85é") for _ in range(n % 40)),) for n in range(400)] + [(None,)]
    ranked = spark.createDataFrame(rows, "t string").withColumn("ranks", fx.word_ranks(F.col("t")))
    assert "split(" not in _plan(ranked)  # no array of characters
    for r in ranked.collect():
        if r.t is not None:
            starts = [i for i, c in enumerate(r.t) if c not in fx.SPACE_CHARS and (i == 0 or r.t[i - 1] in fx.SPACE_CHARS)]
            assert r.ranks[:len(r.t) + 1] == [sum(s < p for s in starts) for p in range(len(r.t) + 1)], repr(r.t)


def test_first_sentences_as_of_the_whole_text(spark, monkeypatch):
    draw = random.Random(5)
    parts = ["Mr", "A", ".", ".", "!", " ", " ", "U", "Corp", "word", "1", "", "\n", '"']
    rows = [(i, "".join(draw.choice(parts) for _ in range(i % 200))) for i in range(2000)] + [(-1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(map(tuple, annotate.sentences(docs, 1 << 30).filter("sent_idx < 3").collect()))
    for likely in (1, 4, 30):
        monkeypatch.setattr(annotate, "LIKELY", likely)
        assert sorted(map(tuple, annotate.sentences(docs).collect())) == whole


def test_short_phrases_stay_in_the_row(spark):
    texts = spark.createDataFrame([(1, "a b cd efgh"), (2, ""), (3, None)], "k long, text string")
    lexicon = spark.createDataFrame([(0, "a b"), (1, ""), (2, "cd ef"), (3, "x"), (4, None)], "lex_ord long, status string")
    for small in (0, lexicons.BROADCAST_LIMIT):
        hits = lexicons._joined_hits(texts, ["k"], lexicon, small)
        assert sorted((r.k, r.lex_ord) for r in hits.collect()) == [(1, 0), (1, 1), (1, 2), (2, 1)]
        assert _plan(hits).count("Join Inner") == (2 if small else 3)  # none for the short ones


def test_lexicon_reads_written_sentences(spark, monkeypatch):
    sents = spark.createDataFrame([(1, i, "ab cd ef") for i in range(10)], "doc_id long, sent_idx int, sent string")
    monkeypatch.setattr(inputs, "annotated", lambda *_: sents)
    monkeypatch.setattr(inputs, "doc_sent", None)
    assert [(r.status, r.n) for r in inputs._lexicon(spark, "").orderBy("lex_ord").collect()] == [("ab cd", 10), ("cd ef", 10)]
