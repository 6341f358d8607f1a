"""Registered training-set queries: L1-L9, S10."""

from __future__ import annotations

from pyspark.sql import functions as F

from slotloom.operators import entities as ents
from slotloom.operators import features
from slotloom.operators import training as ops
from slotloom.plans.catalog.candidates import annotations
from slotloom.plans.catalog.features import vectors
from slotloom.plans.catalog.inputs import (
    SLOT_LIST, VIEWS, annotated, ctes, document_entities, location, no_punct, staged, ws_words,
)
from slotloom.plans.catalog.spans import BY_INDEX, BY_OFFSET, MAXIMAL, chunks, references_sql, tokens
from slotloom.plans.catalog.texts import sent_phrase
from slotloom.slots import SLOTS
from slotloom.sources.features import read_training_rows, write_training_rows
from slotloom.session import scratch_path

ROW_KEYS = ["doc_id", "sent_idx", "label", "text", "root_idx"]

# Gold texts: a word pair of each sentence and every fourth chunk, in slots by place.
VIEWS["gold_doc"] = (("sent_phrase", "chunk"), f"""
    SELECT doc_id, text, max_by(slot, place) AS slot, min(place) AS place FROM (
      SELECT doc_id, text, {SLOT_LIST}[CAST((doc_id + sent_idx) % 7 + 1 AS INT)] AS slot, CAST(sent_idx AS BIGINT) AS place FROM sent_phrase WHERE k = 1
      UNION ALL SELECT doc_id, text, {SLOT_LIST}[CAST((doc_id + ord) % 7 + 1 AS INT)], CAST(1000 + sent_idx * 1000000 + ord AS BIGINT) FROM chunk WHERE ord % 4 = 0)
    GROUP BY doc_id, text""")


def sents(spark, folder):
    """The kept sentences, as they were written with their annotation."""
    return annotated(spark, folder).select("doc_id", "sent_idx", "sent")


def gold(spark, folder):
    """Gold texts ``(doc_id, text, slot, place)`` derived from the documents; L2, L4 and L5 read them more than once."""
    return staged(spark, folder, "gold", lambda: _gold(spark, folder))


def _gold(spark, folder):
    slots = F.array(*[F.lit(s) for s in SLOTS])
    pairs = sent_phrase(spark, folder, sents(spark, folder)).filter("k = 1").select(
        "doc_id", "text", F.get(slots, ((F.col("doc_id") + F.col("sent_idx")) % 7).cast("int")).alias("slot"),
        F.col("sent_idx").cast("long").alias("place"),
    )
    some = chunks(spark, folder).filter("ord % 4 = 0").select(
        "doc_id", "text", F.get(slots, ((F.col("doc_id") + F.col("ord")) % 7).cast("int")).alias("slot"),
        (1000 + F.col("sent_idx").cast("long") * 1000000 + F.col("ord")).alias("place"),
    )
    return pairs.unionByName(some).groupBy("doc_id", "text").agg(
        F.max_by("slot", "place").alias("slot"), F.min("place").alias("place")
    )


def _pairs(spark, folder):
    return ops.overlaps(chunks(spark, folder), gold(spark, folder))


def l1_gold_by_slot(spark, folder):
    return ops.gold_by_slot(gold(spark, folder)).select("doc_id", "slot", F.array_join("texts", "|").alias("texts"))


def l2_overlap_label(spark, folder):
    return _pairs(spark, folder)


def l2_negatives(spark, folder):
    return ops.negatives(chunks(spark, folder), _pairs(spark, folder))


def l3_exact_label(spark, folder):
    return ops.exact_labels(chunks(spark, folder), _pairs(spark, folder))


def _injected(spark, folder, compat):
    exact = ops.exact_labels(chunks(spark, folder), _pairs(spark, folder))
    return ops.injected_gold(gold(spark, folder), exact, sents(spark, folder), tokens(spark, folder), compat)


def l4_inject_gold(spark, folder):
    return _injected(spark, folder, True)


def l4_inject_gold_by_offset(spark, folder):
    return _injected(spark, folder, False)


def l5_substring_label(spark, folder):
    return ops.substring_labels(chunks(spark, folder), gold(spark, folder)).select("doc_id", "sent_idx", "ord", "text", "label")


def _marked(spark, folder):
    return ents.mark_references(document_entities(spark, folder))


def l6_entity_label(spark, folder):
    return ops.entity_labels(chunks(spark, folder), _marked(spark, folder)).select("doc_id", "sent_idx", "ord", "text", "ent_label")


def labelled(spark, folder):
    """L2-L6 over the documents table, shared by the queries below."""
    return staged(spark, folder, "labelled", lambda: ops.training_candidates(
        chunks(spark, folder), gold(spark, folder), sents(spark, folder), tokens(spark, folder), _marked(spark, folder)))


def l_training_rows(spark, folder):
    return labelled(spark, folder)


def l7_balance_negatives(spark, folder):
    return ops.balance_negatives(_copied(labelled(spark, folder)), ROW_KEYS).select(*ROW_KEYS)


def _copied(rows):
    """Every ``none`` row twelve times over, told apart by its sentence number, so there are enough."""
    copies = F.when(F.col("label") == "none", F.array(*[F.lit(i * 1000) for i in range(12)])).otherwise(F.array(F.lit(0)))
    return rows.withColumn("copy", F.explode(copies)).withColumn("sent_idx", F.col("sent_idx") + F.col("copy")).drop("copy").distinct()


def l8_index_labels(spark, folder):
    return ops.index_labels(labelled(spark, folder)).select(*ROW_KEYS, "label_idx")


def l9_split(spark, folder):
    return ops.split(labelled(spark, folder), ROW_KEYS).select(*ROW_KEYS, "is_train")


def _written(rows, name):
    """The rows written, one folder per label, and read back."""
    path = scratch_path(rows.sparkSession, name)
    write_training_rows(rows, path)
    return read_training_rows(rows.sparkSession, path)


def training_features(spark, folder):
    """F12 of the training rows, written once as S10 does, for S10 and the model queries."""
    def build():
        a = annotations(spark, folder)
        rows = features.describe(labelled(spark, folder), a.docs, a.sents, annotated(spark, folder))
        return features.assemble(rows, vectors(spark, folder)).select(*ROW_KEYS, "ent_label", "features")

    return staged(spark, folder, "training_rows", build, _written)


def s10_write_training_rows(spark, folder):
    return training_features(spark, folder).select(*ROW_KEYS, "ent_label", F.size("features").alias("width"))


VIEWS["pair2"] = (("chunk", "gold_doc"), f"""
    SELECT c.doc_id, c.sent_idx, c.ord, c.text AS chunk_text, g.text AS gold_text, g.slot, c.root_idx
    FROM (SELECT *, {ws_words('text')} AS w FROM chunk) c
    JOIN (SELECT *, list_transform({ws_words('text')}, lambda t: {no_punct('t')}) AS w FROM gold_doc) g
      ON g.doc_id = c.doc_id AND (list_has_all(c.w, g.w) OR list_has_all(g.w, c.w))""")
VIEWS["negative"] = (("chunk", "pair2"), """
    SELECT doc_id, sent_idx, text, root_idx, 'none' AS label FROM chunk c
    WHERE NOT EXISTS (SELECT 1 FROM pair2 p WHERE p.doc_id = c.doc_id AND p.sent_idx = c.sent_idx AND p.ord = c.ord)""")
VIEWS["exact"] = (("pair2",), """
    SELECT doc_id, sent_idx, gold_text AS text, min_by(root_idx, ord) AS root_idx, slot AS label
    FROM pair2 WHERE chunk_text = gold_text GROUP BY doc_id, sent_idx, gold_text, slot""")
VIEWS["found"] = (("gold_doc", "doc_sent", "exact"), f"""
    SELECT g.doc_id, s.sent_idx, g.text, g.slot AS label, {location('g.text', 's.sent')} AS loc,
           strpos(s.sent, g.text) + length(g.text) - 2 AS last_char
    FROM gold_doc g JOIN doc_sent s ON s.doc_id = g.doc_id AND contains(s.sent, g.text)
    WHERE NOT EXISTS (SELECT 1 FROM exact e WHERE e.doc_id = s.doc_id AND e.sent_idx = s.sent_idx AND e.text = g.text)""")


def _inject_sql(places: str, place: str) -> str:
    return f"""SELECT w.doc_id, w.sent_idx, w.text, t.tok_idx AS root_idx, w.label FROM (SELECT *, loc.b AS b FROM found) w
               JOIN {places} t ON t.doc_id = w.doc_id AND t.sent_idx = w.sent_idx AND t.place = {place}"""


INJECT = _inject_sql(*BY_INDEX)
VIEWS["plain_ent"] = (("doc_ent", "doc_pair"), f"""
    SELECT doc_id, text, label AS ent_label FROM ({references_sql('doc_ent', 'doc_id', MAXIMAL, 'true')
    .replace('FROM pair_q', 'FROM doc_pair').replace('FROM pair', 'FROM doc_pair pair')}) WHERE NOT is_reference""")
VIEWS["labelled"] = (("negative", "exact", "found", "token_at", "plain_ent"), f"""
    SELECT r.doc_id, r.sent_idx, r.text, r.root_idx, r.label, coalesce(p.ent_label, 'nonent') AS ent_label
    FROM (SELECT * FROM negative UNION ALL SELECT doc_id, sent_idx, text, root_idx, label FROM exact UNION ALL {INJECT}) r
    LEFT JOIN plain_ent p USING (doc_id, text)""")
VIEWS["copied"] = (("labelled",), """
    SELECT DISTINCT doc_id, sent_idx + copy AS sent_idx, label, text, root_idx
    FROM (SELECT *, unnest(CASE WHEN label = 'none' THEN list_transform(range(12), lambda i: i * 1000) ELSE [0] END) AS copy FROM labelled)""")
KEYS = ", ".join(ROW_KEYS)


def _hash(seed: int) -> str:
    return f"md5(concat_ws('|', {KEYS}, '{seed}'))"


QUERIES = {
    "l1_gold_by_slot": (l1_gold_by_slot, ctes(
        "SELECT doc_id, slot, string_agg(text, '|' ORDER BY place, text) AS texts FROM gold_doc GROUP BY doc_id, slot", "gold_doc")),
    "l2_overlap_label": (l2_overlap_label, ctes(
        "SELECT doc_id, sent_idx, ord, chunk_text, gold_text, slot FROM pair2", "pair2")),
    "l2_negatives": (l2_negatives, ctes("SELECT * FROM negative", "negative")),
    "l3_exact_label": (l3_exact_label, ctes("SELECT * FROM exact", "exact")),
    "l4_inject_gold": (l4_inject_gold, ctes(INJECT, "found", "token_at")),
    "l4_inject_gold_by_offset": (l4_inject_gold_by_offset, ctes(
        _inject_sql(*BY_OFFSET), "found", "token_over")),
    "l5_substring_label": (l5_substring_label, ctes("""
        SELECT c.doc_id, c.sent_idx, c.ord, c.text, coalesce(min_by(g.slot, g.place), 'none') AS label
        FROM chunk c LEFT JOIN gold_doc g ON g.doc_id = c.doc_id AND (contains(g.text, c.text) OR contains(c.text, g.text))
        GROUP BY c.doc_id, c.sent_idx, c.ord, c.text""", "chunk", "gold_doc")),
    "l6_entity_label": (l6_entity_label, ctes("""
        SELECT c.doc_id, c.sent_idx, c.ord, c.text, coalesce(p.ent_label, 'nonent') AS ent_label
        FROM chunk c LEFT JOIN plain_ent p USING (doc_id, text)""", "chunk", "plain_ent")),
    "l_training_rows": (l_training_rows, ctes("SELECT * FROM labelled", "labelled")),
    "l7_balance_negatives": (l7_balance_negatives, ctes(f"""
        SELECT {KEYS} FROM copied WHERE label <> 'none'
        UNION ALL SELECT {KEYS} FROM (SELECT *, row_number() OVER (ORDER BY {_hash(1)}, {KEYS}) AS r FROM copied WHERE label = 'none')
        WHERE r <= (SELECT count(*) FROM copied WHERE label <> 'none')""", "copied")),
    "l8_index_labels": (l8_index_labels, ctes(
        f"SELECT {KEYS}, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INT) AS label_idx FROM labelled", "labelled")),
    "l9_split": (l9_split, ctes(f"SELECT {KEYS}, {_hash(0)}[1:1] < 'c' AS is_train FROM labelled", "labelled")),
    "s10_write_training_rows": (s10_write_training_rows, ctes(
        f"SELECT {KEYS}, ent_label, CAST(98 + 7 * 64 AS INT) AS width FROM labelled", "labelled")),
}
