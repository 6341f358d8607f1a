"""Registered span queries: T3-T7, E1-E3, E7."""

from __future__ import annotations

from pyspark.sql import functions as F

from slotloom.functions.text import BOILERPLATE, PRONOUNS
from slotloom.operators import annotate as ann
from slotloom.operators import entities as ents
from slotloom.plans.catalog.inputs import (
    SPACES, VIEWS, annotated, ctes, doc_sent, document_entities, gazetteer, location, quote, sentence_entities, spans,
)


def _in(words) -> str:
    return "(" + ", ".join(quote(w) for w in words) + ")"


CLASS_SQL = " ".join(f"WHEN lower(tok) IN {_in(words)} THEN '{name}'" for name, words in ann.WORD_CLASSES.items())
VIEWS["tagged"] = (("placed",), f"""
    SELECT *, CASE WHEN NOT regexp_matches(tok, '[\\p{{L}}\\p{{N}}]') THEN 'PUNCT'
                   WHEN regexp_matches(tok, '^[0-9][0-9.]*$') THEN 'NUM' {CLASS_SQL}
                   WHEN regexp_matches(tok, '^[a-z].*(ed|ing|ise|ize)$') THEN 'VERB'
                   WHEN regexp_matches(tok, '^\\p{{Lu}}') THEN 'PROPN'
                   WHEN suffix(tok, 'ly') THEN 'ADV'
                   WHEN regexp_matches(tok, '(ous|ful|ive|able|al|ic)$') THEN 'ADJ'
                   ELSE 'NOUN' END AS pos FROM placed""")
DEP_SQL = " ".join(f"WHEN pos = '{pos}' THEN '{dep}'" for pos, dep in ann.DEPENDENCIES.items())
VIEWS["token"] = (("tagged",), f"""
    SELECT doc_id, sent_idx, tok_idx, tok, pos,
           CASE WHEN tok_idx = root THEN 'ROOT' {DEP_SQL} WHEN tok_idx < root THEN 'nsubj' ELSE 'dobj' END AS dep,
           CASE WHEN pos = 'VERB' THEN root ELSE coalesce(near, root) END AS head_idx, start, "end"
    FROM (SELECT *, coalesce(min(CASE WHEN pos = 'VERB' THEN tok_idx END) OVER (PARTITION BY doc_id, sent_idx), 0) AS root,
                 max(CASE WHEN pos = 'VERB' THEN tok_idx END) OVER (PARTITION BY doc_id, sent_idx ORDER BY tok_idx
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS near FROM tagged)""")


def runs_sql(flag: str, keep: str, label: str) -> str:
    """SQL for maximal runs of flagged tokens that hold a kept one."""
    return f"""
    SELECT r.doc_id, r.sent_idx, r.ord, trim(s.sent[r.start + 1:r.stop], {SPACES}) AS text, {label} AS label, r.start, r.stop AS "end", r.root_idx
    FROM (SELECT doc_id, sent_idx, min(tok_idx) AS ord, min(start) AS start, max("end") AS stop, max(tok_idx) AS root_idx, bool_or({keep}) AS kept
          FROM (SELECT *, tok_idx - row_number() OVER (PARTITION BY doc_id, sent_idx ORDER BY tok_idx) AS island FROM token WHERE {flag})
          GROUP BY doc_id, sent_idx, island) r
    JOIN doc_sent s USING (doc_id, sent_idx) WHERE r.kept"""


VIEWS["rule_ent"] = (("token", "doc_sent"), runs_sql("pos = 'PROPN'", "true", "'ORG'") + f"""
    UNION ALL SELECT * FROM ({runs_sql(f"(pos = 'NUM' OR lower(tok) IN {_in(ann.MONEY_UNITS)})", "pos = 'NUM'", "'MONEY'")})
    WHERE regexp_matches(lower(text), '[^0-9.\\s]')""")
VIEWS["chunk"] = (("token", "doc_sent"), runs_sql(f"pos IN {_in(ann.NOMINAL)}", f"pos IN {_in(ann.CHUNK_CORE)}", "'nonent'"))


def chunks(spark, folder):
    return ann.noun_chunks(annotated(spark, folder))


def tokens(spark, folder):
    return ann.token_rows(annotated(spark, folder))


def t3_annotate(spark, folder):
    return ann.token_rows(ann.annotate(doc_sent(spark, folder)))


def t4_entities(spark, folder):
    return ann.entities(annotated(spark, folder))


def t4_entities_gazetteer(spark, folder):
    return ann.entities(annotated(spark, folder), gazetteer(spark, folder))


def t5_noun_chunks(spark, folder):
    return chunks(spark, folder)


def _lowered(spark, folder):
    """Chunks and pronouns as the two filters meet them, every fifth chunk replaced by a boilerplate word."""
    text = F.when(F.col("ord") % 5 == 0, F.lit(BOILERPLATE[0])).otherwise(F.col("text"))
    return chunks(spark, folder).withColumn("text", text)


def t6_drop_boilerplate(spark, folder):
    return ann.drop_boilerplate(_lowered(spark, folder)).select("doc_id", "sent_idx", "ord", "text")


def t7_drop_pronouns(spark, folder):
    low = chunks(spark, folder).withColumn("text", F.lower("text"))
    return ann.drop_pronouns(low).select("doc_id", "sent_idx", "ord", "text")


def e1_dedup_entities(spark, folder):
    return sentence_entities(spark, folder)


def e2_mark_references(spark, folder):
    return ents.mark_references(document_entities(spark, folder))


def e2b_mark_references_in_order(spark, folder):
    return ents.mark_references_in_order(sentence_entities(spark, folder))


def _places(spark, folder):
    return sentence_entities(spark, folder).filter("label IN ('GPE', 'FAC')")


def e3_merge_locations(spark, folder):
    return ents.merge_locations(_places(spark, folder), doc_sent(spark, folder))


def _texts(spark, folder):
    found = spans(spark, folder).select("doc_id", "sent_idx", "text")
    absent = doc_sent(spark, folder).select("doc_id", "sent_idx", F.lit("#absent#").alias("text"))
    return found.unionByName(absent).unionByName(chunks(spark, folder).select("doc_id", "sent_idx", "text"))


def e7_match_to_chunk(spark, folder):
    return ents.match_to_chunk(_texts(spark, folder), chunks(spark, folder), tokens(spark, folder), doc_sent(spark, folder))


def e7_match_by_offset(spark, folder):
    return ents.match_to_chunk(
        _texts(spark, folder), chunks(spark, folder), tokens(spark, folder), doc_sent(spark, folder), compat=False
    )


CORE = f"trim(trim(i.text, {SPACES}), '''s')"


def references_sql(ent: str, key: str, writer: str, namer: str) -> str:
    """SQL for E2 and E2b: ``writer`` and ``namer`` say which containers count."""
    return f"""
    SELECT e.*, w.refers_to, b.referred_by, w.refers_to IS NOT NULL AS is_reference
    FROM {ent} e
    LEFT JOIN (SELECT {key}, i_text AS text, max_by(o_text, o_ord) AS refers_to FROM pair WHERE {writer} GROUP BY ALL) w USING ({key}, text)
    LEFT JOIN (SELECT {key}, o_text AS text, max_by(i_text, i_ord) AS referred_by FROM pair WHERE {namer} GROUP BY ALL) b USING ({key}, text)"""


def _pair_view(ent: str, key: str, needle: str) -> str:
    on = " AND ".join(f"o.{k} = i.{k}" for k in key.split(", "))
    cols = ", ".join(f"o.{k}" for k in key.split(", "))
    return f"""SELECT {cols}, o.text AS o_text, o.ord AS o_ord, i.text AS i_text, i.ord AS i_ord
               FROM {ent} o JOIN {ent} i ON {on} AND o.text <> i.text AND contains(o.text, {needle})"""


VIEWS["doc_pair"] = (("doc_ent",), _pair_view("doc_ent", "doc_id", "i.text"))
VIEWS["sent_pair"] = (("ent",), _pair_view("ent", "doc_id, sent_idx", CORE))
MAXIMAL = "NOT EXISTS (SELECT 1 FROM pair_q q WHERE q.doc_id = pair.doc_id AND q.i_text = pair.o_text)"
ACTIVE = """NOT EXISTS (SELECT 1 FROM pair_q q WHERE q.doc_id = pair.doc_id AND q.sent_idx = pair.sent_idx
                        AND q.i_text = pair.o_text AND q.o_ord < q.i_ord)"""
VIEWS["chunk_first"] = (("chunk",), "SELECT doc_id, sent_idx, text, min_by(root_idx, ord) AS root FROM chunk GROUP BY ALL")
VIEWS["wanted"] = (("span", "doc_sent", "chunk"), """
    SELECT doc_id, sent_idx, text FROM span UNION SELECT doc_id, sent_idx, '#absent#' FROM doc_sent
    UNION SELECT doc_id, sent_idx, text FROM chunk""")


VIEWS["token_at"] = (("token",), """
    SELECT doc_id, sent_idx, tok_idx, tok, tok_idx AS place FROM token
    UNION ALL SELECT doc_id, sent_idx, max(tok_idx), max_by(tok, tok_idx), -1 FROM token GROUP BY doc_id, sent_idx""")
VIEWS["token_over"] = (("token",), """
    SELECT doc_id, sent_idx, tok_idx, tok, unnest(range(start, "end")) AS place FROM token""")


def match_sql(wanted: str, places: str, place: str) -> str:
    """SQL for E7."""
    return f"""
    SELECT w.doc_id, w.sent_idx, w.text, CASE WHEN w.root IS NOT NULL THEN w.text ELSE coalesce(t.tok, f.tok) END AS anchor,
           coalesce(w.root, t.tok_idx, f.tok_idx) AS root_idx
    FROM (SELECT x.*, c.root, loc.b AS b, strpos(sent, text) + length(text) - 2 AS last_char
          FROM (SELECT DISTINCT v.doc_id, v.sent_idx, v.text, s.sent, {location('v.text', 's.sent')} AS loc
                FROM {wanted} v JOIN doc_sent s USING (doc_id, sent_idx)) x
          LEFT JOIN chunk_first c USING (doc_id, sent_idx, text)) w
    LEFT JOIN {places} t ON t.doc_id = w.doc_id AND t.sent_idx = w.sent_idx AND t.place = {place}
    LEFT JOIN token f ON f.doc_id = w.doc_id AND f.sent_idx = w.sent_idx AND f.tok_idx = 0"""


# the view of tokens by place, and the place where a text ends
BY_INDEX = ("token_at", "CASE WHEN w.b = 0 THEN -1 ELSE greatest(w.b - 1, 0) END")
BY_OFFSET = ("token_over", "CASE WHEN w.b > 0 THEN w.last_char END")
E7_VIEWS = ("wanted", "chunk_first", "token", "doc_sent")


def merge_sql(places: str) -> str:
    """SQL for E3."""
    return f"""
    SELECT m.doc_id, m.sent_idx, m.ord, CASE WHEN n > 1 THEN s.sent[m.start + 1:m.stop] ELSE m.text END AS text,
           CASE WHEN n > 1 THEN 'LOC' ELSE m.label END AS label, m.start, m.stop AS "end"
    FROM (SELECT doc_id, sent_idx, count(*) AS n, min(ord) AS ord, min_by(text, ord) AS text, min_by(label, ord) AS label,
                 min(start) AS start, max("end") AS stop
          FROM (SELECT *, sum(starts) OVER (PARTITION BY doc_id, sent_idx ORDER BY ord ROWS UNBOUNDED PRECEDING) AS island
                FROM (SELECT *, CASE WHEN lag("end") OVER (PARTITION BY doc_id, sent_idx ORDER BY ord) >= start - 7
                                     THEN 0 ELSE 1 END AS starts FROM {places}))
          GROUP BY doc_id, sent_idx, island) m
    JOIN doc_sent s USING (doc_id, sent_idx)"""


QUERIES = {
    "t3_annotate": (t3_annotate, ctes("SELECT * FROM token", "token")),
    "t4_entities": (t4_entities, ctes("SELECT * FROM rule_ent", "rule_ent")),
    "t4_entities_gazetteer": (t4_entities_gazetteer, ctes("""
        SELECT r.* REPLACE (coalesce(g.label, r.label) AS label) FROM rule_ent r LEFT JOIN gaz g USING (text)""", "rule_ent", "gaz")),
    "t5_noun_chunks": (t5_noun_chunks, ctes("SELECT * FROM chunk", "chunk")),
    "t6_drop_boilerplate": (t6_drop_boilerplate, ctes(
        "SELECT doc_id, sent_idx, ord, text FROM chunk WHERE ord % 5 <> 0 AND text <> 'Reuter'", "chunk")),
    "t7_drop_pronouns": (t7_drop_pronouns, ctes(
        f"SELECT doc_id, sent_idx, ord, lower(text) AS text FROM chunk WHERE lower(text) NOT IN {_in(PRONOUNS)}", "chunk")),
    "e1_dedup_entities": (e1_dedup_entities, ctes("SELECT * FROM ent", "ent")),
    "e2_mark_references": (e2_mark_references, ctes(
        references_sql("doc_ent", "doc_id", MAXIMAL, "true").replace("FROM pair_q", "FROM doc_pair").replace("FROM pair", "FROM doc_pair pair"),
        "doc_ent", "doc_pair")),
    "e2b_mark_references_in_order": (e2b_mark_references_in_order, ctes(
        references_sql("ent", "doc_id, sent_idx", ACTIVE, ACTIVE).replace("FROM pair_q", "FROM sent_pair").replace("FROM pair", "FROM sent_pair pair"),
        "ent", "sent_pair")),
    "e3_merge_locations": (e3_merge_locations, ctes(
        merge_sql("(SELECT * FROM ent WHERE label IN ('GPE', 'FAC'))"), "ent", "doc_sent")),
    "e7_match_to_chunk": (e7_match_to_chunk, ctes(match_sql("wanted", *BY_INDEX), *E7_VIEWS, "token_at")),
    "e7_match_by_offset": (e7_match_by_offset, ctes(match_sql("wanted", *BY_OFFSET), *E7_VIEWS, "token_over")),
}
