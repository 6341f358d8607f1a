"""words to look up are made per text and per sentence, not per candidate, and give the same vectors; the queries' checksum."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from slotloom.functions import matching
from slotloom.operators import annotate, features


def _parts(spark):
    draw = random.Random(7)
    words = ["Fox", "Corp.", "bought", "12", "the", "...", "U.S.", "deal,", "said", "1,200", "é", "'s"]
    docs = spark.createDataFrame([(d, " ".join(draw.choice(words) for _ in range(30))) for d in range(6)], "doc_id long, text string")
    sents = annotate.sentences(docs)
    tagged = annotate.annotate(sents)
    tagged = spark.createDataFrame(tagged.collect(), tagged.schema)
    cands = []
    for r in sents.collect():
        tokens = r.sent.split()
        for k in range(8):
            a = draw.randrange(len(tokens))
            text = draw.choice([" ".join(tokens[a:a + draw.randrange(3)]), "not there", ""])
            cands.append((r.doc_id, "status", r.sent_idx, k, text, "nonent", draw.randrange(len(tokens))))
    kinds = "doc_id long, slot string, sent_idx int, cand_idx int, text string, ent_label string, root_idx int"
    return spark.createDataFrame(cands, kinds), docs, sents, tagged


def test_words_come_with_the_described_rows(spark):
    described = features.describe(*_parts(spark))
    plain = described.drop("_words").withColumn("_row", F.lit(0))
    made = features._keyed(plain).select(*[c for c in plain.columns if c != "_row"], "_words")
    got, want = (sorted(map(repr, df.select(made.columns).collect())) for df in (described, made))
    assert got == want and len(got) > 50
    # One cut and one look-up for the text, the sentence's words and its tokens, wherever the candidates are joined.
    plan = described._jdf.queryExecution().optimizedPlan().toString()
    above = plan.split("Join")[0]
    assert "split(" not in above and "translate(" not in above


def test_checksum_is_the_sum_from_left_to_right():
    draw = random.Random(3)
    lists = [[draw.uniform(-1e6, 1e6) for _ in range(n % 7)] for n in range(50)] + [None, [1.0, None], [], [-0.0], [1e300, 1e300, -1e300]]
    got = matching._weighted(pa.array(lists, pa.list_(pa.float64())).slice(1)).to_pylist()
    for numbers, found in zip(lists[1:], got):
        want = None if numbers is None or None in numbers else 0.0
        if want is not None:
            for i, x in enumerate(numbers):
                want += x * (i + 1)
        assert repr(found) == repr(want)


def test_checksum_needs_no_lambda_per_number(spark):
    from slotloom.plans.catalog.features import _check

    frame = spark.createDataFrame([([1.0, 2.0, 4.5],), ([],), (None,)], "vec array<double>")
    found = frame.select(*_check(F.col("vec")))
    assert "aggregate(" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.checksum, r.v1) for r in found.collect()] == [(pytest.approx(18.5), 2.0), (0.0, None), (None, None)]


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_numbers_and_one_hot_entries_stand_in_front(spark, limit):
    draw = random.Random(9)
    pick = lambda words: draw.choice([*words[:3], "odd", None])
    rows = [(i, draw.choice([None, i]), i % 5, i % 3, pick(features.DEP_LABELS), pick(features.POS_TAGS), pick(features.DEP_LABELS),
             pick(features.ENTITY_LABELS), *["deal"] * 7) for i in range(60)]
    names = ["id", "freq", "sentence_loc", "sent_idx", "dep", "head_pos", "head_dep", "ent_label", *features.VECTOR_ROLES]
    described = spark.createDataFrame(rows, ", ".join(f"{n} {'int' if k < 4 else 'string'}" for k, n in enumerate(names)))
    vectors = spark.createDataFrame([("unknown", [9.0]), ("deal", [0.5])], "word string, vec array<float>")
    hot = [features.one_hot(F.col(c), v) for c, v in (
        ("dep", features.DEP_LABELS), ("head_pos", features.POS_TAGS), ("head_dep", features.DEP_LABELS), ("ent_label", features.ENTITY_LABELS))]
    numbers = F.array(*[F.col(c).cast("double") for c in names[1:4]])
    want = described.select("id", F.concat(numbers, *hot, F.array_repeat(F.lit(0.5).cast("double"), 7)).alias("features"))
    made = features.assemble(described, vectors, limit)
    assert "coalesce(" not in made._jdf.queryExecution().optimizedPlan().toString()  # no entry by entry expression
    got, wanted = ({r.id: r.features for r in df.collect()} for df in (made.select("id", "features"), want))
    assert got == wanted and any(f[0] is None for f in got.values())
