"""Headline queries at one scale, as one JSON line.

``BENCH_SF_DIR`` names the tables (default /root/testdata/sf0.1), ``BENCH_CPUS`` the local cores.
Every query's whole result is written to a sink that drops it.
"""

from __future__ import annotations

import json
import os
import time

from slotloom.plans.catalog import load
from slotloom.session import local_session

HEADLINES = (
    "r9_corpus_scores", "s3_read_templates", "t1_sentences", "t3_annotate", "e5_lexicon_hits", "e2_mark_references",
    "f10_nearest_verb_rules", "l2_overlap_label", "c7_all_candidates", "s13_document_report", "f1_freq_in_doc",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINES
    spark = local_session(cpus, "slotloom-bench")
    known = load()
    spark.read.parquet(f"{folder}/nation.parquet").count()  # start the executors before the clock
    seconds = {}
    for name in names:
        begun = time.time()
        known[name][0](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - begun, 3)
    spark.stop()
    print(json.dumps({
        "metric": "slotloom_headline_queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
