"""Whole jobs on invented documents, plan checks, and registered queries next to SQL."""

import pytest

from oracle import compare, connect
from slotloom.operators import model, training
from slotloom.plans import extract, train
from slotloom.plans.catalog import load
from slotloom.sources import documents as docs_io
from slotloom.sources import templates as io
from slotloom.session import stage
from slotloom.sources.lexicon import read_lexicon, write_lexicon

FOLDER = "/root/testdata/sf0.001"
QUICK = (
    "r5_greedy_match", "r9_corpus_scores", "s3b_continuation_strict", "t1_sentences", "t3_annotate", "f9_context_window",
    "e2_mark_references", "e5_lexicon_hits_joined", "c7_all_candidates", "f8_embed", "f10_nearest_verb", "l2_overlap_label",
    "l7_balance_negatives", "m3_pick_slot", "m5_classification_report",
)


def _corpus(folder):
    buyers = ["Red Fox", "Grey Owl", "Tall Oak", "Deep Well"]
    (folder / "docs").mkdir()
    keys, names = [], []
    for i in range(12):
        buyer, target = buyers[i % 4], f"{buyers[(i + 1) % 4]} Foods"
        (folder / "docs" / f"d{i}").write_text(
            f"\n{buyer} Corp said it bought {target} Inc for {i + 2} mln dlrs.\nThe small deal was completed near Paris.\n"
        )
        names.append(f"d{i}")
        keys.append(
            f'TEXT: d{i}\nACQUIRED: "{target} Inc"\nACQBUS: ---\nACQLOC: ---\nDLRAMT: "{i + 2} mln dlrs"\n'
            f'PURCHASER: "{buyer} Corp"\nSELLER: ---\nSTATUS: "completed"\n'
        )
    (folder / "keys").write_text("\n".join(keys))
    (folder / "list").write_text("\n".join([f".\\docs\\{n}" for n in names] + ["./docs/d0"]) + "\n")
    (folder / "lexicon.json").write_text('{"completed": 3, "signed": 1}')


def test_train_extract_score(spark, tmp_path):
    _corpus(tmp_path)
    docs = docs_io.read_documents(spark, str(tmp_path / "docs"))
    gold = io.read_templates(spark, str(tmp_path / "keys"))
    lexicon = read_lexicon(spark, str(tmp_path / "lexicon.json"))
    words = ["unknown", "number", "bought", "said", "dlrs", "Corp", "Inc"]
    vectors = spark.createDataFrame([(w, [float(i == k) for k in range(7)]) for i, w in enumerate(words)], "word string, vec array<float>")
    rows = train.training_rows(docs, io.gold_texts(io.answer_keys(gold)), vectors)
    rows = rows.cache()
    assert len(rows.first().features) == 98 + 7 * 7
    counts = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    assert counts["status"] == 12 and counts["purchaser"] == 12
    fitted = model.fit(rows, trees=3, depth=3)
    assert model.accuracy(model.score(fitted, rows)).first().accuracy > 0.6
    model.save_model(fitted, str(tmp_path / "model"))
    values = extract.slot_values(docs, lexicon, vectors, model.load_model(str(tmp_path / "model")))
    manifest = docs_io.read_manifest(spark, str(tmp_path / "list"))
    lines = extract.templates_of(values, docs_io.documents_in(docs, manifest).select("ord", "doc_id"))
    io.write_templates(lines, str(tmp_path / "out"), files=1)
    written = io.read_templates(spark, str(tmp_path / "out"))
    assert [r.doc_id for r in io.records(written).orderBy("tmpl_ord").collect()] == [f"d{i}" for i in range(12)] + ["d0"]
    found = {r.value for r in io.values(written).filter("slot = 'status'").collect()}
    assert found <= {'"completed"', '"signed"'}
    write_lexicon(lexicon, str(tmp_path / "copy"))
    assert read_lexicon(spark, str(tmp_path / "copy")).collect() == lexicon.collect()


def test_balancing_first_gives_the_same_rows(spark, tmp_path):
    _corpus(tmp_path)
    for i in range(12):
        path = tmp_path / "docs" / f"d{i}"
        path.write_text(path.read_text().replace(" near Paris.", " near Paris while old mills, long roads, tall towers, cold rivers and wide fields stayed."))
    docs = docs_io.read_documents(spark, str(tmp_path / "docs"))
    gold = io.gold_texts(io.answer_keys(io.read_templates(spark, str(tmp_path / "keys"))))
    vectors = spark.createDataFrame([("unknown", [0.0, 1.0]), ("number", [1.0, 0.0])], "word string, vec array<float>")
    columns = [*train.ROW_KEYS, "features"]
    late = training.balance_negatives(stage(train.training_rows(docs, gold, vectors), "rows"), train.ROW_KEYS)
    first = train.training_rows(docs, gold, vectors, balance=True)
    want = sorted(map(repr, late.select(columns).collect()))
    assert want and sorted(map(repr, first.select(columns).collect())) == want


def test_many_key_files_are_numbered_in_order(spark, tmp_path):
    (tmp_path / "many").mkdir()
    for i in range(40):
        (tmp_path / "many" / f"k{i:02d}").write_text("".join(
            f'TEXT: d{i}-{k}\nSTATUS: "s{k}"\nSELLER: "more"\n\n' for k in range(1 + i % 3)))
    found = io.read_templates(spark, str(tmp_path / "many"))
    want = [f"d{i}-{k}" for i in range(40) for k in range(1 + i % 3)]
    heads = io.records(found).orderBy("tmpl_ord").collect()
    assert [(r.tmpl_ord, r.doc_id) for r in heads] == list(enumerate(want))
    values = [r.value for r in io.values(found).orderBy("val_ord").collect()]
    assert values == [v for d in want for v in (f'"s{d.split("-")[1]}"', '"more"')]


@pytest.mark.parametrize("name", QUICK)
def test_against_sql(spark, name):
    run, sql = load()[name]
    assert compare(spark, connect(FOLDER), FOLDER, run, sql)[0] is None


@pytest.mark.parametrize("name", ("r9_corpus_scores", "e2_mark_references", "e5_lexicon_hits_joined", "c7_all_candidates", "l2_overlap_label"))
def test_no_pairwise_joins(spark, name):
    plan = load()[name][0](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    import pytest

    from slotloom.session import scratch_path

    def session(**conf):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default), set=conf.__setitem__))

    with pytest.raises(ValueError):
        scratch_path(session(**{"spark.master": "spark://host:7077"}), "x")
    assert scratch_path(session(**{"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///shared/"}), "x").startswith("hdfs:///shared/x-")


def test_candidates_shuffle_few_times(spark):
    plan = load()["c7_all_candidates"][0](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 15


def test_manifest_order_over_splits(spark, tmp_path):
    names = [f"d{(i * 37) % 500}" for i in range(500)]
    (tmp_path / "list").write_text("\n".join(f"./docs/{n}" for n in names) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        listed = docs_io.read_manifest(spark, str(tmp_path / "list"))
        assert listed.rdd.getNumPartitions() > 4
        assert [r.doc_id for r in listed.orderBy("ord").collect()] == names
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
