"""Inputs of the registered queries: tables derived from the given ones, in Spark and in SQL.

``ctes(body, *names)`` puts the named SQL views and all they need in front of a query.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotloom.functions.text import SPACE, SPACE_CHARS, let, ws_tokens
from slotloom.operators.annotate import ABBREVIATED, INNER_STOP, MASK, PIECE, SENTENCE, annotate, sentences
from slotloom.operators.entities import dedup_entities
from slotloom.session import broadcast_if_small, ranged, spread, stage
from slotloom.slots import SLOTS
from slotloom.sources.documents import normalise_documents

SLOT_LIST = "[" + ", ".join(f"'{s}'" for s in SLOTS) + "]"

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def ctes(body: str, *names: str, recursive: str = "") -> str:
    """``body`` behind the CTEs it names, in order of need."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for other in VIEWS[name][0]:
            need(other)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        need(name)
    parts = [f"{n} AS ({VIEWS[n][1]})" for n in ordered]
    if recursive:
        parts.append(recursive)
    word = "WITH RECURSIVE" if recursive else "WITH"
    return f"{word} {', '.join(parts)} {body}" if parts else body


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


_STAGED: dict[tuple[str, str, str], DataFrame] = {}


def staged(
    spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame], write: Callable[[DataFrame, str], DataFrame] = stage,
) -> DataFrame:
    """A table that many queries share, written once per application and folder."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _STAGED:
        _STAGED[key] = write(build(), name)
    return _STAGED[key]


# --- templates from lineitem -------------------------------------------------------------------

VIEWS["tv"] = ((), """
    SELECT l_orderkey AS tmpl_ord, CAST(l_orderkey AS VARCHAR) AS doc_id,
           {slots}[CAST(l_linenumber % 7 + 1 AS INT)] AS slot,
           CAST(row_number() OVER (PARTITION BY l_orderkey, l_linenumber % 7
                ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS BIGINT) AS val_ord,
           CASE WHEN (l_orderkey + l_partkey) % 4 = 0
                THEN '"v' || (l_partkey % 5) || '" / "V' || (l_suppkey % 5) || '"'
                ELSE '"v' || (l_partkey % 5) || '"' END AS gold_value,
           CASE WHEN l_suppkey % 2 = 0 THEN '"v' || (l_suppkey % 5) || '"'
                ELSE '"v' || (l_partkey % 5) || '"' END AS resp_value,
           (l_partkey + l_suppkey) % 3 <> 0 AS answered
    FROM lineitem""".replace("{slots}", SLOT_LIST))

VIEWS["gold_v"] = (("tv",), "SELECT tmpl_ord, doc_id, slot, val_ord, gold_value AS value FROM tv")
VIEWS["resp_v"] = (("tv",), "SELECT tmpl_ord, doc_id, slot, val_ord, resp_value AS value FROM tv WHERE answered")
VIEWS["rec"] = (("tv",), "SELECT DISTINCT tmpl_ord, doc_id FROM tv")
VIEWS["gold_opts"] = (("gold_v",), """
    SELECT tmpl_ord, slot, val_ord, list_distinct(list_filter(list_transform(
             string_split(value, '/'), lambda o: lower(trim(o))), lambda o: o <> '')) AS opts
    FROM gold_v""")
VIEWS["g_arr"] = (("gold_opts",), """
    SELECT tmpl_ord, slot, list(opts ORDER BY val_ord) AS golds FROM gold_opts GROUP BY ALL""")
VIEWS["r_arr"] = (("resp_v",), """
    SELECT tmpl_ord, slot, list(lower(value) ORDER BY val_ord) AS answers FROM resp_v GROUP BY ALL""")

GREEDY = """
  fold AS (
    SELECT tmpl_ord, slot, 0 AS i, golds AS remaining, 0 AS correct FROM g_arr
    UNION ALL
    SELECT tmpl_ord, slot, i + 1,
           CASE WHEN p > 0 THEN list_concat(remaining[1:p - 1], remaining[p + 1:len(remaining)]) ELSE remaining END,
           correct + CASE WHEN p > 0 THEN 1 ELSE 0 END
    FROM (SELECT f.tmpl_ord, f.slot, f.i, f.remaining, f.correct,
                 coalesce(list_position(list_transform(f.remaining, lambda g: list_contains(g, a.answers[f.i + 1])), true), 0) AS p
          FROM fold f JOIN r_arr a USING (tmpl_ord, slot) WHERE f.i < len(a.answers))
  ),
  matched AS (SELECT tmpl_ord, slot, CAST(max(correct) AS BIGINT) AS correct FROM fold GROUP BY tmpl_ord, slot),
  tally AS (
    SELECT r.tmpl_ord, r.doc_id, s.slot, coalesce(m.correct, 0) AS correct,
           CAST(coalesce(a.n, 0) AS BIGINT) AS generated, CAST(coalesce(g.n, 0) AS BIGINT) AS gold
    FROM rec r CROSS JOIN (SELECT unnest({slots}) AS slot) s
    LEFT JOIN matched m ON m.tmpl_ord = r.tmpl_ord AND m.slot = s.slot
    LEFT JOIN (SELECT tmpl_ord, slot, len(answers) AS n FROM r_arr) a ON a.tmpl_ord = r.tmpl_ord AND a.slot = s.slot
    LEFT JOIN (SELECT tmpl_ord, slot, len(golds) AS n FROM g_arr) g ON g.tmpl_ord = r.tmpl_ord AND g.slot = s.slot
  )""".replace("{slots}", SLOT_LIST)


def prf_sql(source: str, keys: str) -> str:
    """SQL for R7 over summed tallies."""
    return f"""
    SELECT {keys}, correct, generated, gold, recall, precision,
           CASE WHEN recall + precision = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f
    FROM (SELECT *, CASE WHEN gold = 0 THEN 0 ELSE correct::DOUBLE / gold END AS recall,
                 CASE WHEN generated = 0 THEN 0 ELSE correct::DOUBLE / generated END AS precision
          FROM ({source}))"""


def template_values(spark: SparkSession, folder: str) -> DataFrame:
    """Gold and output values side by side, from lineitem; some orders repeat a line number."""
    place = Window.partitionBy("l_orderkey", F.col("l_linenumber") % 7).orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    slots = F.array(*[F.lit(s) for s in SLOTS])

    def value(number, letter='"v'):
        return F.concat(F.lit(letter), (F.col(number) % 5).cast("string"), F.lit('"'))

    part = value("l_partkey")
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("tmpl_ord"),
        F.col("l_orderkey").cast("string").alias("doc_id"),
        F.get(slots, F.col("l_linenumber") % 7).alias("slot"),
        F.row_number().over(place).cast("long").alias("val_ord"),
        F.when(
            (F.col("l_orderkey") + F.col("l_partkey")) % 4 == 0,
            F.concat(part, F.lit(" / "), value("l_suppkey", '"V')),
        ).otherwise(part).alias("gold_value"),
        F.when(F.col("l_suppkey") % 2 == 0, value("l_suppkey")).otherwise(part).alias("resp_value"),
        ((F.col("l_partkey") + F.col("l_suppkey")) % 3 != 0).alias("answered"),
    )


def _with_records(rows: DataFrame, all_rows: DataFrame) -> DataFrame:
    heads = all_rows.select("tmpl_ord", "doc_id").distinct().select(
        "tmpl_ord", "doc_id", F.lit(None).cast("string").alias("slot"),
        F.lit(-1).cast("long").alias("val_ord"), F.lit(None).cast("string").alias("value"),
    )
    return heads.unionByName(rows)


def templates(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(output, gold) template tables; every order is a record on both sides."""
    rows = stage(template_values(spark, folder), "template_values")
    keys = ["tmpl_ord", "doc_id", "slot", "val_ord"]
    gold = rows.select(*keys, F.col("gold_value").alias("value"))
    resp = rows.filter("answered").select(*keys, F.col("resp_value").alias("value"))
    return _with_records(resp, rows), _with_records(gold, rows)


# --- documents: text, sentences, tokens, words, lexicons --------------------------------------------

def quote(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


SPACES = quote(SPACE_CHARS)
VIEWS["doc_text"] = ((), f"SELECT doc_id, text AS raw, trim(replace(text, chr(10), ' '), {SPACES}) AS text FROM documents")
VIEWS["doc_sent"] = (("doc_text",), f"""
    SELECT doc_id, CAST(unnest(range(len(kept))) AS INT) AS sent_idx, unnest(kept) AS sent
    FROM (SELECT doc_id, list_filter(list_transform(regexp_extract_all(regexp_replace(regexp_replace(text,
                   {quote(INNER_STOP)}, {quote(MASK)} || '\\1', 'g'), {quote(ABBREVIATED)}, '\\1\\2' || {quote(MASK)}, 'g'),
                   {quote(SENTENCE)}), lambda s: trim(replace(s, {quote(MASK)}, '.'), {SPACES})), lambda s: s <> '')[1:3] AS kept
          FROM doc_text)""")
VIEWS["word"] = (("doc_sent",), f"""
    SELECT doc_id, sent_idx, CAST(unnest(range(len(w))) AS INT) AS tok_idx, unnest(w) AS tok, unnest(p) AS piece
    FROM (SELECT doc_id, sent_idx, regexp_extract_all(sent, {quote(PIECE)}, 2) AS w,
                 regexp_extract_all(sent, {quote(PIECE)}, 0) AS p FROM doc_sent)""")
VIEWS["placed"] = (("word",), """
    SELECT doc_id, sent_idx, tok_idx, tok, CAST(e - length(tok) AS INT) AS start, CAST(e AS INT) AS "end"
    FROM (SELECT *, sum(length(piece)) OVER (PARTITION BY doc_id, sent_idx ORDER BY tok_idx
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS e FROM word)""")
PUNCTUATION = quote(string.punctuation)


def ws_words(text: str) -> str:
    """SQL for T2."""
    return f"list_filter(regexp_split_to_array({text}, {quote(SPACE + '+')}), lambda t: t <> '')"


def no_punct(token: str) -> str:
    """SQL for T9."""
    return f"translate({token}, {PUNCTUATION}, '')"


def number(token: str) -> str:
    """SQL for T10."""
    return f"regexp_matches({no_punct(token)}, '^\\p{{Nd}}+$')"


def location(text: str, sent: str) -> str:
    """SQL for F2 as a struct."""
    before = f"len({ws_words(f'{sent}[1:strpos({sent}, {text}) - 1]')})"
    return (
        f"CASE WHEN strpos({sent}, {text}) > 0 THEN {{'a': CAST({before} AS INT), "
        f"'b': CAST({before} + len({ws_words(text)}) AS INT)}} ELSE {{'a': -1, 'b': -1}} END"
    )


# The gazetteer holds every word that looks like a name, the lexicon every pair of words that occurs so often.
NAME = r"^\p{Lu}\p{Ll}+$"
LETTER_PAIR = r"^\p{L}+ \p{L}+$"
OFTEN = 10

# Word counts over whole documents; single marks and numbers are no words.
VIEWS["word_count"] = (("doc_text",), f"""
    SELECT w AS word, count(*) AS n FROM (SELECT unnest({ws_words('text')}) AS w FROM doc_text)
    WHERE regexp_matches(w, '^\\p{{L}}+$') GROUP BY w""")
VIEWS["gaz"] = (("word_count",), f"""
    SELECT word AS text, ['ORG', 'GPE', 'MONEY', 'PERSON', 'FAC'][(strpos('0123456789abcdef', md5(word)[1:1]) - 1) % 5 + 1] AS label
    FROM word_count WHERE regexp_matches(word, {quote(NAME)})""")
VIEWS["pairs"] = (("doc_sent",), f"""
    SELECT w[i] || ' ' || w[i + 1] AS pair
    FROM (SELECT w, unnest(range(1, len(w))) AS i FROM (SELECT {ws_words('sent')} AS w FROM doc_sent))""")
VIEWS["lex"] = (("pairs",), """
    SELECT row_number() OVER (ORDER BY n DESC, pair) - 1 AS lex_ord, pair AS status, n
    FROM (SELECT pair, count(*) AS n FROM pairs GROUP BY pair)
    WHERE n >= {often} AND regexp_matches(pair, {letters})""".replace("{often}", str(OFTEN)).replace("{letters}", quote(LETTER_PAIR)))
VIEWS["opening"] = ((), """
    SELECT row_number() OVER (ORDER BY status) - 1 AS lex_ord, status, 1 AS n
    FROM (SELECT DISTINCT regexp_extract(text, '^\\S+\\s+\\S+', 0) AS status FROM benchmark) WHERE status <> ''""")


def doc_text(spark: SparkSession, folder: str) -> DataFrame:
    """S1 over the documents table."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return normalise_documents(spread(docs, "doc_id"))


def doc_sent(spark: SparkSession, folder: str) -> DataFrame:
    """T1 over the documents table."""
    return sentences(doc_text(spark, folder))


def word_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of alphabetic words over whole documents."""
    # Counted first, so that each distinct word is looked at once; that drops empty ones too.
    words = doc_text(spark, folder).select(F.explode(F.split("text", SPACE + "+")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.rlike("word", F.lit(r"^\p{L}+$")))


def numbered(df: DataFrame, name: str, *order) -> DataFrame:
    """``df`` with ``place``, each row's number from 0 in an order without ties.

    Ranges of the order are counted and ranked one by one, so no task sees all rows; only the ranges' sizes meet in one.
    """
    ranges = ranged(df, name, *order)
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = ranges.groupBy("_range").agg(F.count("*").alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return ranges.withColumn("_rank", rank).join(before, "_range").withColumn(
        "place", (F.col("_rank") + F.col("_before")).cast("long")).drop("_range", "_rank", "_before")


def gazetteer(spark: SparkSession, folder: str) -> DataFrame:
    """Every word of the documents that looks like a name, with an entity label by its hash."""
    return staged(spark, folder, "gazetteer", lambda: _gazetteer(spark, folder))


def _gazetteer(spark: SparkSession, folder: str) -> DataFrame:
    labels = F.array(*[F.lit(x) for x in ("ORG", "GPE", "MONEY", "PERSON", "FAC")])
    digit = F.position(F.substring(F.md5("word"), 1, 1), F.lit("0123456789abcdef")) - 1
    return word_counts(spark, folder).filter(F.rlike("word", F.lit(NAME))).select(
        F.col("word").alias("text"), F.get(labels, digit % 5).alias("label")
    )


def lexicon(spark: SparkSession, folder: str) -> DataFrame:
    """Every pair of words that occurs at least ``OFTEN`` times in the kept sentences, frequent ones first."""
    return staged(spark, folder, "lexicon", lambda: _lexicon(spark, folder))


def _lexicon(spark: SparkSession, folder: str) -> DataFrame:
    words = ws_tokens(F.col("sent"))
    pairs = F.zip_with(words, F.slice(words, F.lit(2), F.size(words)), lambda a, b: F.concat(a, F.lit(" "), b))
    counts = (
        annotated(spark, folder).select("sent").select(F.explode(pairs).alias("pair")).filter("pair IS NOT NULL")
        .groupBy("pair").agg(F.count("*").alias("n"))
    )
    often = counts.filter(F.rlike("pair", F.lit(LETTER_PAIR)) & (F.col("n") >= OFTEN))
    return numbered(often, "pairs", F.col("n").desc(), F.col("pair")).select(
        F.col("place").alias("lex_ord"), F.col("pair").alias("status"), "n")


def openings(spark: SparkSession, folder: str) -> DataFrame:
    """The first two words of every benchmark item, as a lexicon over whole documents."""
    found = (
        table(spark, folder, "benchmark")
        .select(F.regexp_extract("text", r"^\S+\s+\S+", 0).alias("status"))
        .filter("status <> ''").distinct()
    )
    return staged(spark, folder, "openings", lambda: numbered(found, "openings_ranges", F.col("status")).select(
        F.col("place").alias("lex_ord"), "status", F.lit(1).alias("n")))


# --- spans: tokens that are in the gazetteer, every third one stretched over its neighbour --------------

VIEWS["span"] = (("placed", "doc_sent", "gaz"), """
    SELECT p.doc_id, p.sent_idx, p.tok_idx AS ord, s.sent[p.start + 1:p.stop] AS text, g.label, p.start, p.stop AS "end"
    FROM (SELECT doc_id, sent_idx, tok_idx, tok, start,
                 CASE WHEN tok_idx % 3 = 0 THEN coalesce(lead("end") OVER w, "end") ELSE "end" END AS stop
          FROM placed WINDOW w AS (PARTITION BY doc_id, sent_idx ORDER BY tok_idx)) p
    JOIN gaz g ON g.text = p.tok JOIN doc_sent s ON s.doc_id = p.doc_id AND s.sent_idx = p.sent_idx""")
VIEWS["ent"] = (("span",), """
    SELECT doc_id, sent_idx, text, min(ord) AS ord, max_by(label, ord) AS label, max_by(start, ord) AS start, max_by("end", ord) AS "end"
    FROM span GROUP BY doc_id, sent_idx, text""")
# the same over all sentences of a document
VIEWS["whole_sent"] = (("doc_text",), VIEWS["doc_sent"][1].replace("[1:3]", ""))
VIEWS["whole_word"] = (("whole_sent",), VIEWS["word"][1].replace("doc_sent", "whole_sent"))
VIEWS["whole_placed"] = (("whole_word",), VIEWS["placed"][1].replace("FROM word", "FROM whole_word"))
VIEWS["whole_span"] = (("whole_placed", "whole_sent", "gaz"), VIEWS["span"][1].replace("placed", "whole_placed").replace("doc_sent", "whole_sent"))
VIEWS["doc_ent"] = (("whole_span",), """
    SELECT doc_id, text, min(o) AS ord, max_by(label, o) AS label, max_by(start, o) AS start, max_by("end", o) AS "end"
    FROM (SELECT *, CAST(sent_idx AS BIGINT) * 4294967296 + ord AS o FROM whole_span) GROUP BY doc_id, text""")


def annotated(spark: SparkSession, folder: str) -> DataFrame:
    """T3 over the kept sentences; annotated once for all queries, as a corpus would be."""
    return staged(spark, folder, "annotated", lambda: annotate(doc_sent(spark, folder)))


def spans(spark: SparkSession, folder: str, sents: DataFrame | None = None) -> DataFrame:
    """Entity spans whose first token is in the gazetteer, of annotated sentences (the kept ones by default)."""

    def placed(t, i):
        return F.struct(i.alias("ord"), t["tok"].alias("tok"), t["start"].alias("start"), t["end"].alias("end"))

    def span(t):
        following = F.get(F.col("toks"), t["ord"] + 1)["end"]
        stop = F.when(t["ord"] % 3 == 0, F.coalesce(following, t["end"])).otherwise(t["end"])
        return let(stop, lambda e: F.struct(
            t["ord"].alias("ord"), t["tok"].alias("tok"), t["start"].alias("start"), e.alias("end"),
            F.substr(F.col("sent"), t["start"] + 1, e - t["start"]).alias("text"),
        ))

    sents = annotated(spark, folder) if sents is None else sents
    # The gazetteer holds names alone, so other tokens stay behind.
    names = F.filter(F.transform("toks", placed), lambda t: F.rlike(t["tok"], F.lit(NAME)))
    found = sents.select("doc_id", "sent_idx", F.inline(F.transform(names, span)))
    gaz = broadcast_if_small(gazetteer(spark, folder), "text").withColumnRenamed("text", "tok")
    return found.join(gaz, "tok").select("doc_id", "sent_idx", "ord", "text", "label", "start", "end")


def sentence_entities(spark: SparkSession, folder: str) -> DataFrame:
    """E1 of the spans, per sentence."""
    return dedup_entities(spans(spark, folder))


def document_entities(spark: SparkSession, folder: str) -> DataFrame:
    """E1 of the spans of all sentences, per document; E2 reads them three times."""
    return staged(spark, folder, "document_entities", lambda: _document_entities(spark, folder))


def _document_entities(spark: SparkSession, folder: str) -> DataFrame:
    whole = staged(spark, folder, "whole", lambda: annotate(sentences(doc_text(spark, folder), 1 << 30)))
    place = F.shiftleft(F.col("sent_idx").cast("long"), 32) + F.col("ord")
    placed = spans(spark, folder, whole).withColumn("ord", place)
    return dedup_entities(placed, ("doc_id",))
