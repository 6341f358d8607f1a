"""A sentence is cut once, and heads are the last verbs before, made without a running sum."""

from slotloom.operators import annotate


def test_sentence_is_cut_once_and_heads_are_the_last_verb(spark):
    texts = ["The Fox said it bought U.S. Corp. for 12 mln dlrs and is walking quickly .", "", "no name", "said", " ", "Buys the red famous house, sold"]
    sents = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)] + [(2, 0, None)], "doc_id long, sent_idx int, sent string")
    made = annotate.annotate(sents)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1
    found = {(r.doc_id, r.sent_idx): r for r in made.collect()}
    assert found[2, 0].toks is None and found[1, 1].toks == [] == found[1, 4].toks
    for i, text in enumerate(texts):
        toks = found[1, i].toks
        verbs = [k for k, t in enumerate(toks) if t.pos == "VERB"]
        root = verbs[0] if verbs else 0
        for k, t in enumerate(toks):
            before = [v for v in verbs if v < k]
            assert t.head_idx == (root if t.pos == "VERB" or not before else before[-1])
            assert text[t.start:t.end] == t.tok
    assert [t.pos for t in found[1, 5].toks] == ["VERB", "DET", "VERB", "ADJ", "NOUN", "PUNCT", "VERB"]
