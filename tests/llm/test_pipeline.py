"""The stages one after another, each against a plain version on its own input."""

import corpus_pipeline
from slotloom.llm import rules
from test_near import brute as classes
from test_repeats import brute as repeats

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, tables = docs.columns, [docs]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "substring_dedup", "best_fit_packing"]
    for _, function in corpus_pipeline.STAGES:
        tables.append(corpus_pipeline.stage(function(spark, tables[-1], FOLDER), "stage"))
    rows = [[r.asDict() for r in t.collect()] for t in tables]
    assert all(t.columns == columns for t in tables[:4])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in rows[1]}
    judged = {r.row.doc_id: r.base_failed for r in rules.statistics(docs).collect()}
    assert kept <= {d for d, failed in judged.items() if not failed}
    clean = [d for d, failed in judged.items() if labels.get(d) == 1 and not failed]
    assert len(kept & set(clean)) >= 0.98 * len(clean)
    pairs = [(r["doc_id"], r["text"]) for r in rows[1]]
    assert {r["doc_id"] for r in rows[2]} == set(classes(pairs)) and len(rows[2]) == len(set(classes(pairs)))
    want = dict(zip((r["doc_id"] for r in rows[2]), (w[3] for w in repeats([r["text"] for r in rows[2]], 35))))
    assert {r["doc_id"]: r["text"] for r in rows[3]} == want and all(r["n_chars"] == len(r["text"]) for r in rows[3])
    assert {r["doc_id"] for r in rows[4]} == set(want)
    assert sorted(map(repr, rows[4])) and len({(r["doc_id"], r["piece"]) for r in rows[4]}) == len(rows[4])
