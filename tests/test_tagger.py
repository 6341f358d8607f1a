"""Both jobs with an invented tagger, and the checks of what a tagger gives."""

import sys

import pytest
from pyspark import cloudpickle

from slotloom.operators import annotate, model
from slotloom.plans import extract, train


# Executors have no copy of the tests.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def tagger(sentences):
    """Words by white space; each word that begins with X is an ORG and a chunk; the first word is the root."""
    out = []
    for sent in sentences:
        toks, spans, at = [], [], 0
        for i, word in enumerate(sent.split()):
            at = sent.index(word, at)
            toks.append({"tok": word, "pos": "VERB" if i == 1 else "NOUN", "dep": "ROOT" if i == 0 else "dobj",
                         "head_idx": 0, "start": at, "end": at + len(word)})
            if word.startswith("X"):
                spans.append({"text": word, "label": "ORG", "start": at, "end": at + len(word), "root_idx": i})
            at += len(word)
        out.append({"toks": toks, "ents": spans, "chunks": [dict(s, label="nonent") for s in spans]})
    return out


def _sents(spark):
    return spark.createDataFrame([(1, 0, "Xa buys Xb"), (1, 1, ""), (2, 0, None)], "doc_id long, sent_idx int, sent string")


def test_tagger_gives_the_tables(spark):
    found = annotate.annotate_with(_sents(spark), tagger)
    assert [(r.tok, r.start) for r in annotate.token_rows(found).orderBy("tok_idx").collect()] == [("Xa", 0), ("buys", 3), ("Xb", 8)]
    assert [(r.ord, r.text, r.label) for r in annotate.entities(found).orderBy("ord").collect()] == [(0, "Xa", "ORG"), (1, "Xb", "ORG")]
    assert {(r.text, r.root_idx) for r in annotate.noun_chunks(found).collect()} == {("Xa", 0), ("Xb", 2)}
    known = spark.createDataFrame([("Xb", "GPE")], "text string, label string")
    assert {(r.text, r.label) for r in annotate.entities(found, known).collect()} == {("Xa", "ORG"), ("Xb", "GPE")}


def _broken(change):
    def tag(sentences):
        out = tagger(sentences)
        return change(out)
    return tag


@pytest.mark.parametrize("change", [
    lambda out: out[:-1] + [{}],
    lambda out: out + out,
    lambda out: [dict(o, toks=[dict(t, head_idx=99) for t in o["toks"]]) for o in out],
    lambda out: [dict(o, toks=[dict(t, tok=7) for t in o["toks"]]) for o in out],
    lambda out: [dict(o, ents=[{"text": s["text"]} for s in o["ents"]]) for o in out],
])
def test_wrong_annotations_are_errors(spark, change):
    with pytest.raises(Exception, match="sentence|annotations|need|Arrow|string|bytes"):
        annotate.annotate_with(_sents(spark).filter("sent <> ''"), _broken(change)).collect()


def test_jobs_with_a_tagger(spark):
    texts = [(f"d{i}", f"Xa{i % 3} buys Xb{i % 3} today.\nIt ended.") for i in range(12)]
    docs = spark.createDataFrame([(d, t, t) for d, t in texts], "doc_id string, raw string, text string")
    gold = spark.createDataFrame(
        [(f"d{i}", slot, 0, f"{p}{i % 3}") for i in range(12) for slot, p in (("purchaser", "Xa"), ("acquired", "Xb"))],
        "doc_id string, slot string, place int, text string")
    vectors = spark.createDataFrame([("unknown", [1.0, 0.0]), ("buys", [0.0, 1.0])], "word string, vec array<float>")
    rows = train.training_rows(docs, gold, vectors, tagger=tagger).cache()
    assert {(r.label, r.text[:2]) for r in rows.collect()} == {("purchaser", "Xa"), ("acquired", "Xb")}
    assert {r.ent_label for r in rows.collect()} == {"ORG"}
    fitted = model.fit(rows, trees=2, depth=2)
    lexicon = spark.createDataFrame([(0, "ended")], "lex_ord long, status string")
    values = {(r.doc_id, r.slot): r.text for r in extract.slot_values(docs, lexicon, vectors, fitted, tagger=tagger).collect()}
    assert len(values) == 12 * 7
    assert all(values[f"d{i}", "purchaser"] == f"Xa{i % 3}" for i in range(12))
