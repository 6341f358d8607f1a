"""Registered text queries: S1, T1, T2, T8-T11, F1-F3, F9, E4-E6."""

from __future__ import annotations

from pyspark.sql import functions as F

from slotloom.functions import text as fx
from slotloom.operators import lexicons
from slotloom.plans.catalog.inputs import (
    SPACES, VIEWS, ctes, doc_sent, doc_text, lexicon, location, no_punct, number, openings, quote, ws_words,
)

# Phrases looked for in sentences: each sentence's own third and fourth word, and a frequent syllable.
VIEWS["sent_phrase"] = (("doc_sent",), f"""
    SELECT doc_id, sent_idx, sent, k, text FROM (
      SELECT doc_id, sent_idx, sent, w, unnest([0, 1, 2, 3]) AS k,
             unnest([w[1], coalesce(w[3] || ' ' || w[4], w[1]), w[len(w)], 'er']) AS text
      FROM (SELECT doc_id, sent_idx, sent, {ws_words('sent')} AS w FROM doc_sent))""")


def sent_phrase(spark, folder, sents=None):
    """Four phrases per sentence (the kept ones by default): its first word, a pair, its last word, and a syllable."""
    w = fx.ws_tokens(F.col("sent"))
    first = F.get(w, F.lit(0))
    texts = F.array(
        first, F.coalesce(F.concat(F.get(w, F.lit(2)), F.lit(" "), F.get(w, F.lit(3))), first),
        F.get(w, F.size(w) - 1), F.lit("er"),
    )
    sents = doc_sent(spark, folder) if sents is None else sents
    return sents.select("doc_id", "sent_idx", "sent", F.posexplode(texts).alias("k", "text"))


def s1_read_documents(spark, folder):
    return doc_text(spark, folder).select("doc_id", "text")


def t1_sentences(spark, folder):
    return doc_sent(spark, folder)


def t2_ws_tokens(spark, folder):
    return doc_sent(spark, folder).select(
        "doc_id", "sent_idx", F.posexplode(fx.ws_tokens(F.col("sent"))).alias("tok_idx", "tok")
    )


def _tokens(spark, folder):
    return t2_ws_tokens(spark, folder).select("tok").distinct()


def t8_strip_article(spark, folder):
    low = _tokens(spark, folder).select("tok", F.lower("tok").alias("low"))
    return low.select(
        "tok", fx.strip_article(F.col("low")).alias("cut"),
        fx.strip_article(F.concat("low", F.lit(" x")), compat=False).alias("cut_word"),
    )


def t9_strip_punct(spark, folder):
    return _tokens(spark, folder).select("tok", fx.strip_punct(F.col("tok")).alias("bare"))


def t10_is_number(spark, folder):
    return _tokens(spark, folder).select("tok", fx.is_number(F.col("tok")).alias("is_number"))


def t11_quote_value(spark, folder):
    missing = F.when(F.length("tok") % 3 != 0, F.concat(F.lit(" "), "tok"))
    return _tokens(spark, folder).select("tok", fx.quote_value(missing).alias("value"))


def f1_freq_in_doc(spark, folder):
    phrases = sent_phrase(spark, folder)
    return phrases.join(doc_text(spark, folder).select("doc_id", F.col("text").alias("doc")), "doc_id").select(
        "doc_id", "sent_idx", "k", fx.frequency(F.col("text"), F.col("doc")).alias("freq")
    )


def f2_sentence_loc(spark, folder):
    return sent_phrase(spark, folder).select(
        "doc_id", "sent_idx", "k", fx.sentence_loc(F.col("text"), F.col("sent")).alias("loc")
    ).select("doc_id", "sent_idx", "k", "loc.a", "loc.b")


def f2_ranked_loc(spark, folder):
    ranked = sent_phrase(spark, folder).withColumn("ranks", fx.word_ranks(F.col("sent")))
    loc = fx.ranked_loc(F.col("text"), F.col("sent"), F.col("ranks"))
    return ranked.select("doc_id", "sent_idx", "k", loc.alias("loc")).select("doc_id", "sent_idx", "k", "loc.a", "loc.b")


def f3_sentence_num(spark, folder):
    return doc_sent(spark, folder).select("doc_id", "sent_idx")


def f9_context_window(spark, folder):
    placed = sent_phrase(spark, folder).withColumn("loc", fx.sentence_loc(F.col("text"), F.col("sent")))
    window = fx.context_window(F.col("loc"), fx.ws_tokens(F.col("sent")))
    return placed.select("doc_id", "sent_idx", "k", window.alias("w")).select(
        "doc_id", "sent_idx", "k", *[F.get("w", F.lit(i)).alias(f"w{i}") for i in range(4)]
    )


def _phrases(spark, folder):
    """Every pair of the lexicon, and their first words of eight letters or more."""
    lex = lexicon(spark, folder)
    one_word = lex.select(F.substring_index("status", " ", 1).alias("phrase")).filter(F.char_length("phrase") >= 8)
    return lex.select(F.col("status").alias("phrase")).unionByName(one_word)


def e4_phrase_spans(spark, folder):
    return lexicons.phrase_spans(doc_text(spark, folder), _phrases(spark, folder))


def e4_undisclosed_amounts(spark, folder):
    return lexicons.undisclosed_amounts(doc_text(spark, folder), doc_sent(spark, folder), _phrases(spark, folder))


def e5_lexicon_hits(spark, folder):
    return lexicons.lexicon_hits(doc_sent(spark, folder), lexicon(spark, folder))


def e5_lexicon_hits_joined(spark, folder):
    return lexicons.lexicon_hits(doc_sent(spark, folder), lexicon(spark, folder), limit=0)


def e6_first_lexicon_hit(spark, folder):
    return lexicons.first_lexicon_hit(doc_text(spark, folder), openings(spark, folder))


def e6_first_lexicon_hit_joined(spark, folder):
    return lexicons.first_lexicon_hit(doc_text(spark, folder), openings(spark, folder), limit=0)


VIEWS["tok"] = (("doc_sent",), f"SELECT DISTINCT unnest({ws_words('sent')}) AS tok FROM doc_sent")
VIEWS["phrase"] = (("lex",), """
    SELECT status AS phrase FROM lex
    UNION SELECT split_part(status, ' ', 1) FROM lex WHERE length(split_part(status, ' ', 1)) >= 8""")


def _piece_words(text):
    from slotloom.operators.annotate import PIECE

    return f"regexp_extract_all({text}, {quote(PIECE)}, 2)"


VIEWS["doc_word"] = (("doc_text",), f"""
    SELECT doc_id, CAST(unnest(range(len(w))) AS INT) AS tok_idx, unnest(w) AS tok
    FROM (SELECT doc_id, {_piece_words('text')} AS w FROM doc_text)""")
VIEWS["phrase_span"] = (("doc_word", "phrase"), f"""
    SELECT doc_id, tok_idx, n_tok, text
    FROM (SELECT doc_id, tok_idx, unnest([1, 2, 3, 4]) AS n_tok,
                 unnest([tok, tok || ' ' || t2, tok || ' ' || t2 || ' ' || t3, tok || ' ' || t2 || ' ' || t3 || ' ' || t4]) AS text
          FROM (SELECT *, lead(tok) OVER w AS t2, lead(tok, 2) OVER w AS t3, lead(tok, 3) OVER w AS t4
                FROM doc_word WINDOW w AS (PARTITION BY doc_id ORDER BY tok_idx)))
    WHERE text IN (SELECT array_to_string({_piece_words('phrase')}, ' ') FROM phrase)""")
E5 = ctes("""SELECT s.doc_id, s.sent_idx, l.lex_ord, l.status FROM doc_sent s JOIN lex l ON contains(s.sent, l.status)""",
          "doc_sent", "lex")
E6 = ctes("""SELECT d.doc_id, coalesce('"' || min_by(o.status, o.lex_ord) || '"', '---') AS status
             FROM doc_text d LEFT JOIN opening o ON contains(d.raw, o.status) GROUP BY d.doc_id""", "doc_text", "opening")

QUERIES = {
    "s1_read_documents": (s1_read_documents, ctes("SELECT doc_id, text FROM doc_text", "doc_text")),
    "t1_sentences": (t1_sentences, ctes("SELECT * FROM doc_sent", "doc_sent")),
    "t2_ws_tokens": (t2_ws_tokens, ctes(f"""
        SELECT doc_id, sent_idx, CAST(unnest(range(len(w))) AS INT) AS tok_idx, unnest(w) AS tok
        FROM (SELECT doc_id, sent_idx, {ws_words('sent')} AS w FROM doc_sent)""", "doc_sent")),
    "t8_strip_article": (t8_strip_article, ctes("""
        SELECT tok, CASE WHEN starts_with(lower(tok), 'the') THEN lower(tok)[4:] ELSE lower(tok) END AS cut,
               CASE WHEN lower(tok) = 'the' THEN ' x' ELSE lower(tok) || ' x' END AS cut_word FROM tok""", "tok")),
    "t9_strip_punct": (t9_strip_punct, ctes(f"SELECT tok, {no_punct('tok')} AS bare FROM tok", "tok")),
    "t10_is_number": (t10_is_number, ctes(f"SELECT tok, {number('tok')} AS is_number FROM tok", "tok")),
    "t11_quote_value": (t11_quote_value, ctes(f"""
        SELECT tok, CASE WHEN length(tok) % 3 <> 0 THEN '"' || trim(' ' || tok, {SPACES}) || '"' ELSE '---' END AS value FROM tok""", "tok")),
    "f1_freq_in_doc": (f1_freq_in_doc, ctes("""
        SELECT p.doc_id, p.sent_idx, p.k,
               CAST((length(d.text) - length(replace(d.text, p.text, ''))) // length(p.text) AS INT) AS freq
        FROM sent_phrase p JOIN doc_text d USING (doc_id)""", "sent_phrase", "doc_text")),
    "f2_sentence_loc": (f2_sentence_loc, ctes(f"""
        SELECT doc_id, sent_idx, k, loc.a AS a, loc.b AS b
        FROM (SELECT *, {location('text', 'sent')} AS loc FROM sent_phrase)""", "sent_phrase")),
    "f2_ranked_loc": (f2_ranked_loc, ctes(f"""
        SELECT doc_id, sent_idx, k, loc.a AS a, loc.b AS b
        FROM (SELECT *, {location('text', 'sent')} AS loc FROM sent_phrase)""", "sent_phrase")),
    "f3_sentence_num": (f3_sentence_num, ctes("SELECT doc_id, sent_idx FROM doc_sent", "doc_sent")),
    "f9_context_window": (f9_context_window, ctes(f"""
        SELECT doc_id, sent_idx, k,
               CASE WHEN a <= 0 THEN 'phi2' WHEN a = 1 THEN 'phi1' ELSE w[a - 1] END AS w0,
               CASE WHEN a <= 0 THEN 'phi1' ELSE w[a] END AS w1,
               CASE WHEN b < 0 OR b >= len(w) THEN 'omega1' ELSE w[b + 1] END AS w2,
               CASE WHEN b < 0 OR b >= len(w) THEN 'omega2' WHEN b + 1 = len(w) THEN 'omega1' ELSE w[b + 2] END AS w3
        FROM (SELECT doc_id, sent_idx, k, w, loc.a AS a, loc.b AS b
              FROM (SELECT *, {ws_words('sent')} AS w, {location('text', 'sent')} AS loc FROM sent_phrase))""", "sent_phrase")),
    "e4_phrase_spans": (e4_phrase_spans, ctes("SELECT * FROM phrase_span", "phrase_span")),
    "e4_undisclosed_amounts": (e4_undisclosed_amounts, ctes(
        "SELECT p.*, s.sent_idx FROM phrase_span p JOIN doc_sent s USING (doc_id)", "phrase_span", "doc_sent")),
    "e5_lexicon_hits": (e5_lexicon_hits, E5),
    "e5_lexicon_hits_joined": (e5_lexicon_hits_joined, E5),
    "e6_first_lexicon_hit": (e6_first_lexicon_hit, E6),
    "e6_first_lexicon_hit_joined": (e6_first_lexicon_hit_joined, E6),
}
