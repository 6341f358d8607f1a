"""Registered lexicon queries: S12, X1, X2."""

from __future__ import annotations

from slotloom.operators import lexicons as ops
from slotloom.plans.catalog.inputs import ctes, lexicon
from slotloom.plans.catalog.templates import _keys
from slotloom.sources.lexicon import lexicon_json, parse_lexicon


def s12_lexicon_json(spark, folder):
    return parse_lexicon(lexicon_json(lexicon(spark, folder)))


def x1_status_counts(spark, folder):
    return ops.status_counts(_keys(spark, folder))


def x2_merge_counts(spark, folder):
    lex = lexicon(spark, folder)
    return ops.merge_counts(lex.filter("n < 50"), lex.filter("n >= 20"))


QUERIES = {
    "s12_lexicon_json": (s12_lexicon_json, ctes("SELECT * FROM lex", "lex")),
    "x1_status_counts": (x1_status_counts, ctes("""
        SELECT text AS status, count(*) AS n
        FROM (SELECT *, val_ord = max(val_ord) OVER (PARTITION BY doc_id, slot) AND alt_idx = 0 AS is_primary FROM quoted)
        WHERE slot = 'status' AND is_primary GROUP BY text""", "quoted")),
    "x2_merge_counts": (x2_merge_counts, ctes("""
        SELECT status, CAST(sum(n) AS BIGINT) AS n
        FROM (SELECT * FROM lex WHERE n < 50 UNION ALL SELECT * FROM lex WHERE n >= 20) GROUP BY status""", "lex")),
}
