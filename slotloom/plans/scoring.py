"""The scoring job: output and gold template files to scores and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from slotloom.operators import scoring
from slotloom.sources import report
from slotloom.session import stage
from slotloom.sources.templates import read_templates, records


def score_files(spark: SparkSession, output: str, gold: str, by: str = "position") -> dict[str, DataFrame]:
    """``tally``, ``documents``, ``corpus``, ``mismatched``, ``size_errors`` and two reports.

    Sets of unequal size are not scored: only ``size_errors`` and ``mismatched`` are returned then.
    """
    answers, keys = stage(read_templates(spark, output), "answers"), stage(read_templates(spark, gold), "keys")
    faults = {"size_errors": scoring.check_sizes(answers, keys), "mismatched": scoring.mismatched(answers, keys)}
    if records(answers).count() != records(keys).count():
        return faults
    pairs = stage(scoring.paired(answers, keys, by), "pairs")
    tallies = stage(scoring.tally_of(pairs), "tally")
    documents, corpus = scoring.document_scores(tallies), scoring.corpus_scores(tallies)
    return {
        "tally": tallies,
        "documents": documents,
        "corpus": corpus,
        **faults,
        "corpus_report": report.corpus_report(corpus),
        "document_report": report.document_report(pairs),
    }
