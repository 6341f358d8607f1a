"""Template files, matching and scores on invented templates."""

import pytest
from pyspark.sql import functions as F

from slotloom.functions.scores import two_decimals
from slotloom.operators import lexicons, scoring
from slotloom.plans.scoring import score_files
from slotloom.sources import templates as io

GOLD = '''TEXT: a1
ACQUIRED: "Blue Kite Foods"
acqbus: "frozen peas" / "peas"  
ACQLOC: "Oslo" / "Norway"
ACQLOC: "Bergen"
DLRAMT: ---
PURCHASER: ---
SELLER: ---
STATUS: "signed"

TEXT: a2
ACQUIRED: "Harbor/Mill Co"
ACQUIRED: "Harbor Two"
ACQUIRED: "Harbor Two"
ACQBUS: ---
ACQLOC: ---
DLRAMT: "9 mln dlrs"
PURCHASER: "North" / "South"
PURCHASER: "South"
SELLER: ---
STATUS: ---
'''
OUTPUT = '''TEXT: A1
ACQUIRED: "BLUE KITE FOODS"
ACQBUS: "peas"
ACQLOC: "Norway"
DLRAMT: ---
PURCHASER: "Someone"
SELLER: ---
STATUS: "signed"
 
TEXT: a2
ACQUIRED: "Harbor/Mill Co"
ACQUIRED: "Harbor Two"
ACQBUS: ---
ACQLOC: ---
DLRAMT: "8 mln dlrs"
PURCHASER: "South"
PURCHASER: "North"
SELLER: ---
STATUS: ---
'''


@pytest.fixture
def files(tmp_path):
    (tmp_path / "gold").write_text(GOLD)
    (tmp_path / "out").write_text(OUTPUT)
    return str(tmp_path / "out"), str(tmp_path / "gold")


def test_scores_of_files(spark, files):
    got = score_files(spark, *files)
    corpus = {r.slot: (r.correct, r.generated, r.gold) for r in got["corpus"].collect()}
    # "South" takes the first gold value that allows it, so "North" finds none: greedy, not best.
    assert corpus == {
        "acquired": (2, 3, 4), "acqbus": (1, 1, 1), "acqloc": (1, 1, 2), "dlramt": (0, 1, 1),
        "purchaser": (1, 3, 2), "seller": (0, 0, 0), "status": (1, 1, 1), "total": (6, 10, 11),
    }
    total = got["corpus"].filter("slot = 'total'").first()
    assert total.recall == 6 / 11 and total.precision == 0.6
    lines = [r.line for r in got["corpus_report"].orderBy("line_no").collect()]
    assert lines[-1] == "TOTAL           0.55 (6/11)\t   0.60 (6/10)        0.57"
    assert lines[6] == "SELLER          0.00 (0/0)\t   0.00 (0/0)         0.00"
    assert got["size_errors"].count() == 0
    doc = [r.line for r in got["document_report"].filter("tmpl_ord = 0").orderBy("line_no", "val_ord").collect()]
    assert 'ACQLOC:         "Oslo" / "Norway"' in doc and '                "Bergen"' in doc


def test_inner_slash_matches_outside_compat(spark, files):
    out, gold = (io.read_templates(spark, f) for f in files)
    assert scoring.greedy_match(out, gold, compat=False).filter("slot = 'acquired'").agg(F.sum("correct")).first()[0] == 3


def test_gold_against_itself(spark, files):
    gold = io.read_templates(spark, files[1])
    one = gold.filter("slot IS NULL OR NOT contains(value, '/')")
    total = scoring.corpus_scores(scoring.tally(one, one)).filter("slot = 'total'").first()
    assert total.recall == total.precision == total.f == 1.0


def test_unequal_counts(spark, files, tmp_path):
    (tmp_path / "short").write_text("TEXT: zz\nACQUIRED: ---\n")
    out = io.read_templates(spark, files[0])
    errors = scoring.check_sizes(out, io.read_templates(spark, str(tmp_path / "short"))).collect()
    assert {(r.resp_id, r.gold_id) for r in errors} == {("A1", "zz"), ("a2", "none")}


def test_continuation_lines(spark, tmp_path):
    (tmp_path / "t").write_text(
        'TEXT: x\nACQUIRED: "a"\n   lost\nSELLER: ---\n   found me  \n   "quoted"\nSTATUS: "s"\n   late\n'
    )
    def rows(strict):
        found = io.values(io.read_templates(spark, str(tmp_path / "t"), strict)).orderBy("val_ord").collect()
        return [(r.slot, r.value) for r in found]
    assert rows(True) == [("acquired", '"a"'), ("seller", "found me"), ("status", '"s"'), ("seller", "late")]
    assert rows(False) == [
        ("acquired", '"a"'), ("acquired", "lost"), ("seller", "found me"), ("status", '"s"'), ("status", "late")
    ]


def test_write_and_read_back(spark, files, tmp_path):
    gold = io.read_templates(spark, files[1])
    io.write_templates(io.concat_templates(gold), str(tmp_path / "copy"), files=1)
    again = io.read_templates(spark, str(tmp_path / "copy"))
    key = lambda df: [(r.doc_id, r.slot, r.value) for r in df.orderBy("val_ord").collect()]
    assert key(again) == key(gold)
    io.write_keys_by_document(gold, str(tmp_path / "keys"))
    parts = spark.read.text(str(tmp_path / "keys")).filter("doc_id = 'a1'")
    assert parts.count() == 9
    blank = io.blank_template_lines(io.records(gold).withColumnRenamed("tmpl_ord", "ord"))
    assert blank.filter("line LIKE '%---'").count() == 14


def test_answer_keys(spark, files, tmp_path):
    (tmp_path / "k").write_text('TEXT: d\nACQUIRED: "p" / "q"\nPURCHASER: "q"\nSTATUS: "one"\nSTATUS: "two" / "2"\n')
    keys = io.answer_keys(io.read_templates(spark, str(tmp_path / "k")))
    gold = {r.text: r.slot for r in io.gold_texts(keys).collect()}
    assert gold == {"p": "acquired", "q": "purchaser", "one": "status", "two": "status", "2": "status"}
    assert {(r.status, r.n) for r in lexicons.status_counts(keys).collect()} == {("two", 1)}


def test_pairing_needs_documents(spark):
    docs = spark.createDataFrame([("1", "x"), ("2", "y")], "doc_id string, text string")
    keys = spark.createDataFrame([("1.key",)], "doc_id string")
    assert [r.doc_id for r in io.pair_docs_with_keys(docs, keys).collect()] == ["1"]
    with pytest.raises(ValueError):
        io.pair_docs_with_keys(docs, spark.createDataFrame([("3.key",)], "doc_id string"))


def test_two_decimals_like_c(spark):
    pairs = [(c, t) for t in range(1, 161) for c in range(t + 1)]
    df = spark.createDataFrame(pairs, "c int, t int").select("c", "t", two_decimals(F.col("c") / F.col("t")).alias("s"))
    assert [(r.c, r.t, r.s) for r in df.collect() if r.s != "%.2f" % (r.c / r.t)] == []


def test_repeated_ids_pair_by_occurrence(spark):
    """One gold record, the same document twice in the output: the first of the two is scored."""
    schema = "tmpl_ord long, doc_id string, slot string, val_ord long, value string"
    record = lambda n, i: [(n, i, None, None, None), (n, i, "status", 1, '"x"')]
    gold = spark.createDataFrame(record(0, "a"), schema)
    resp = spark.createDataFrame(record(0, "A") + record(1, "a"), schema)
    assert [tuple(r) for r in scoring.align(resp, gold).collect()] == [(0, "a", 0)]
    row = scoring.tally(resp, gold).filter("slot = 'status'").first()
    assert (row.correct, row.generated, row.gold) == (1, 1, 1)


def test_unequal_sets_are_not_scored(spark, tmp_path):
    slots = "".join(f"{s.upper()}: ---\n" for s in ("acquired", "acqbus", "acqloc", "dlramt", "purchaser", "seller", "status"))
    (tmp_path / "out").write_text("".join(f"TEXT: {i}\n{slots}\n" for i in "ab"))
    (tmp_path / "gold").write_text(f"TEXT: a\n{slots}\n")
    assert set(score_files(spark, str(tmp_path / "out"), str(tmp_path / "gold"))) == {"size_errors", "mismatched"}


def test_lines_are_made_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def told(line):
        seen.add(1)
        return line

    lines = ["TEXT: x", "acquired:\t\"a\" ", "  more", "STATUS:none", "Seller : no", "TEXT:  ", "SELLER: ---", "STATUS: \"s\"", ""]
    placed = spark.createDataFrame([("f", i // 3, i, t) for i, t in enumerate(lines)], "file string, block long, pos long, line string")
    found = io.parse_templates(placed.withColumn("line", F.udf(told, "string").asNondeterministic()("line"))).orderBy("val_ord").collect()
    assert [(r.tmpl_ord, r.doc_id, r.slot, r.value) for r in found] == [
        (0, "x", None, None), (0, "x", "acquired", '"a"'), (0, "x", "acquired", "more"), (1, "", None, None), (1, "", "status", '"s"')]
    assert seen.value == len(lines)


def test_records_are_laid_out_in_their_row(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "ord long, doc_id string")
    filled = spark.createDataFrame(
        [(1, "seller", 2, "y"), (1, "seller", 1, "x"), (2, "status", 5, None), (2, "other", 1, "z"), (None, "seller", 1, "n"), (9, "seller", 1, "n")],
        "ord long, slot string, val_ord long, value string")
    lines = io.template_lines(docs, filled)
    got = sorted((r.ord or 0, r.line_no, r.val_ord, r.line) for r in lines.collect() if "---" not in r.line or r.val_ord)
    assert got == sorted([
        (0, 0, 0, "TEXT: d"), (0, 8, 0, " "), (1, 0, 0, "TEXT: a"), (1, 0, 0, "TEXT: b"), *2 * [(1, 6, 1, "SELLER: x"), (1, 6, 2, "SELLER: y"), (1, 8, 0, " ")],
        (2, 0, 0, "TEXT: c"), (2, 7, 5, "STATUS: ---"), (2, 8, 0, " ")])
    assert lines.count() == 9 * 4 + 2
    # records are expanded above the join, not below it
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Join")
