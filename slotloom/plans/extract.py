"""The extraction job: documents to templates."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotloom.functions.text import strip
from slotloom.operators import annotate, candidates, entities, features, model
from slotloom.session import stage
from slotloom.slots import SLOTS
from slotloom.sources.templates import template_lines


def annotations(
    docs: DataFrame, lexicon: DataFrame, gazetteer: DataFrame | None = None, sentences: int = 3, tagger=None,
) -> tuple[candidates.Annotations, DataFrame]:
    """The annotation of a corpus, by ``tagger`` or the default rules, and its token arrays, written once for all consumers."""
    annotated = stage(annotate.annotated(annotate.sentences(docs, sentences), tagger), "annotated")
    return candidates.Annotations(
        docs=docs,
        sents=annotated.select("doc_id", "sent_idx", "sent"),
        tokens=annotate.token_rows(annotated),
        entities=entities.dedup_entities(annotate.entities(annotated, gazetteer)),
        chunks=annotate.noun_chunks(annotated),
        lexicon=lexicon,
    ), annotated


def slot_values(
    docs: DataFrame, lexicon: DataFrame, vectors: DataFrame, classifier: PipelineModel,
    gazetteer: DataFrame | None = None, compat: bool = True, given: candidates.Annotations | None = None,
    tagger=None,
) -> DataFrame:
    """S1 to M3 in one job: ``(doc_id, slot, text)`` for every document and slot.

    ``tagger`` annotates in place of the default rules (:func:`annotate.annotate_with`).
    ``given`` is an annotation of your own; ``lexicon`` and ``gazetteer`` are not looked at then.
    """
    if given is None:
        tables, arrays = annotations(docs, lexicon, gazetteer, tagger=tagger)
    else:
        tables, arrays = given, features.sentence_arrays(given.tokens)
    found = stage(candidates.all_candidates(tables, compat), "candidates")
    rows = features.assemble(features.describe(found, docs, tables.sents, arrays), vectors)
    scored = model.slot_score(model.score(classifier, rows), model.labels_of(classifier))
    return model.pick_slot(scored, docs)


def templates_of(values: DataFrame, ordered: DataFrame) -> DataFrame:
    """Template lines for ``ordered`` = ``(ord, doc_id)``; a repeated document repeats."""
    quoted = F.concat(F.lit('"'), strip(F.col("text")), F.lit('"'))
    filled = ordered.join(values.filter("text IS NOT NULL"), "doc_id").select(
        "ord", "slot", F.lit(0).alias("val_ord"), quoted.alias("value")
    )
    return template_lines(ordered.select("ord", "doc_id"), filled.filter(F.col("slot").isin(*SLOTS)))
