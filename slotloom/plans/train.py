"""The training job: documents and answer keys to a classifier."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotloom.operators import annotate, candidates, entities, features, model, training
from slotloom.session import stage

ROW_KEYS = ["doc_id", "sent_idx", "label", "text", "root_idx"]


def document_entities(annotated: DataFrame, gazetteer: DataFrame | None = None) -> DataFrame:
    """E1, E2 over whole documents, for L6."""
    spans = annotate.entities(annotated, gazetteer).withColumn("ord", F.struct("sent_idx", "ord"))
    return entities.mark_references(entities.dedup_entities(spans, ("doc_id",)))


def training_rows(
    docs: DataFrame, gold: DataFrame, vectors: DataFrame, gazetteer: DataFrame | None = None, compat: bool = True,
    given: candidates.Annotations | None = None, balance: bool = False, tagger=None,
) -> DataFrame:
    """Labelled feature rows from paired documents and their gold texts.

    Sentences are the first three; entities come from the whole document. ``given`` is an annotation of your own,
    whose entities have distinct texts per document;
    ``tagger`` annotates in place of the default rules. With ``balance``, L7 comes first and only the rows it keeps get features.
    """
    def chosen(rows: DataFrame) -> DataFrame:
        return stage(training.balance_negatives(stage(rows, "labelled"), ROW_KEYS), "balanced_rows") if balance else rows

    if given is not None:
        rows = training.training_candidates(
            given.chunks, gold, given.sents, given.tokens, entities.mark_references(given.entities), compat)
        return features.assemble(
            features.describe(chosen(rows), docs, given.sents, features.sentence_arrays(given.tokens)), vectors)
    whole = stage(annotate.annotated(annotate.sentences(docs, 1 << 30), tagger), "whole")
    annotated = stage(annotate.annotated(annotate.sentences(docs), tagger), "annotated")
    sents = annotated.select("doc_id", "sent_idx", "sent")
    rows = training.training_candidates(
        annotate.noun_chunks(annotated), gold, sents, annotate.token_rows(annotated),
        document_entities(whole, gazetteer), compat,
    )
    return features.assemble(features.describe(chosen(rows), docs, sents, annotated), vectors)


def train(
    rows: DataFrame, trees: int = model.TREES, depth: int = model.DEPTH, balanced: bool = False,
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """The model, its hold-out accuracy and its class report; without L7 for ``balanced`` rows."""
    even = rows if balanced else training.balance_negatives(stage(rows, "training_rows"), ROW_KEYS)
    balanced = stage(training.split(even, ROW_KEYS), "balanced")
    classifier = model.fit(balanced.filter("is_train"), trees, depth)
    held_out = model.score(classifier, balanced.filter("NOT is_train"))
    return classifier, model.accuracy(held_out), model.classification_report(held_out)
