"""Entity operators: deduplication, references, location merging, chunk matching."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotloom.functions.matching import contained
from slotloom.functions.text import ranked_loc, strip, word_ranks

SENTENCE = ("doc_id", "sent_idx")

# Fixed value: two place names up to this many characters apart are one place.
PLACE_GAP = 7


def dedup_entities(spans: DataFrame, keys: tuple[str, ...] = SENTENCE) -> DataFrame:
    """One row per text within ``keys``: the first place in order, the last span's values."""
    last = F.max_by(F.struct("label", "start", "end"), "ord")
    return (
        spans.groupBy(*keys, "text")
        .agg(F.min("ord").alias("ord"), last.alias("span"))
        .select(*keys, "ord", "text", "span.label", "span.start", "span.end")
    )


def gathered_pairs(outer: DataFrame, inner: DataFrame, keys: list[str], find: Callable[[Column, Column], Column]) -> DataFrame:
    """Pairs of rows with equal ``keys``, chosen by ``find``, with the columns of both.

    The rows of each side are gathered, and ``find`` takes both arrays of structs
    and gives the places (o, i) of the pairs. A group is a document or a
    sentence, so its row is bounded by that. Rows with a null key are in no pair.
    """
    def gathered(side: DataFrame, name: str) -> DataFrame:
        others = [c for c in side.columns if c not in keys]
        return side.groupBy(*keys).agg(F.collect_list(F.struct(*others)).alias(name))

    both = gathered(outer, "outs").join(gathered(inner, "ins"), keys)
    pick = lambda side, rows, at: [F.get(rows, at)[c].alias(c) for c in side.columns if c not in keys]
    found = both.withColumn("hits", find(F.col("outs"), F.col("ins")))
    pairs = F.transform("hits", lambda h: F.struct(*pick(outer, F.col("outs"), h["o"]), *pick(inner, F.col("ins"), h["i"])))
    return found.select(*keys, F.inline(pairs))


def containments(outer: DataFrame, inner: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs where ``inner.needle`` is a substring of ``outer.o_text``, within equal ``keys``.

    An automaton over a group's needles finds them in its texts, in time linear
    in the texts and the hits. Null texts are in no pair.
    """
    return gathered_pairs(outer, inner, keys, lambda outs, ins: contained(outs["o_text"], ins["needle"]))


def _pairs(ents: DataFrame, needle: Column, keys: list[str]) -> DataFrame:
    outer = ents.select(*keys, F.col("text").alias("o_text"), F.col("ord").alias("o_ord"))
    inner = ents.select(*keys, needle.alias("needle"), F.col("text").alias("i_text"), F.col("ord").alias("i_ord"))
    return containments(outer, inner, keys).filter("o_text <> i_text")


def _marked(ents: DataFrame, writing: DataFrame, naming: DataFrame, keys: list[str]) -> DataFrame:
    refers = writing.groupBy(*keys, F.col("i_text").alias("text")).agg(
        F.max_by("o_text", "o_ord").alias("refers_to")
    )
    referred = naming.groupBy(*keys, F.col("o_text").alias("text")).agg(
        F.max_by("i_text", "i_ord").alias("referred_by")
    )
    return (
        ents.join(refers, [*keys, "text"], "left")
        .join(referred, [*keys, "text"], "left")
        .withColumn("is_reference", F.col("refers_to").isNotNull())
    )


def mark_references(ents: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """An entity contained in another one's text is a reference to it (training form).

    It refers to the last container in order that is itself contained in none.
    ``ents`` holds distinct texts per ``keys``, as :func:`dedup_entities` gives.
    """
    group = list(keys)
    pairs = _pairs(ents, F.col("text"), group)
    contained = pairs.select(*group, F.col("i_text").alias("o_text")).distinct()
    maximal = pairs.join(contained, [*group, "o_text"], "left_anti")
    return _marked(ents, maximal, pairs, group)


def possessive_core(text: Column) -> Column:
    """A text without white space and then without ``'`` and ``s`` at its ends."""
    return F.btrim(strip(text), F.lit("'s"))


def mark_references_in_order(ents: DataFrame, keys: tuple[str, ...] = SENTENCE) -> DataFrame:
    """The order-dependent form used on single sentences.

    The inner text loses ``'`` and ``s`` at its ends first, so two texts can
    contain each other; then the earlier one wins. An entity marks others unless
    an earlier marking entity contains it. Containment of these cores carries
    over from container to container, so that is the same as: unless any earlier
    entity contains it.
    """
    group = list(keys)
    pairs = _pairs(ents, possessive_core(F.col("text")), group)
    passive = pairs.filter("o_ord < i_ord").select(*group, F.col("i_text").alias("o_text")).distinct()
    active = pairs.join(passive, [*group, "o_text"], "left_anti")
    return _marked(ents, active, active, group)


def merge_locations(ents: DataFrame, sents: DataFrame, gap: int = PLACE_GAP) -> DataFrame:
    """Neighbouring places of a sentence become one span, ``(doc_id, sent_idx, ord, text, label, start, end)``.

    Gaps and islands over the places in order; a merged span takes the
    sentence's text from its first to its last place and the label LOC.
    """
    in_order = Window.partitionBy(*SENTENCE).orderBy("ord")
    starts = F.when(F.lag("end").over(in_order) >= F.col("start") - gap, 0).otherwise(1)
    islands = (
        ents.withColumn("starts", starts)
        .withColumn("island", F.sum("starts").over(in_order))
        .groupBy(*SENTENCE, "island")
        .agg(
            F.count("*").alias("n"),
            F.min("ord").alias("ord"),
            F.min_by(F.struct("text", "label"), "ord").alias("single"),
            F.min("start").alias("start"),
            F.max("end").alias("end"),
        )
    )
    whole = F.substr("sent", F.col("start") + 1, F.col("end") - F.col("start"))
    return islands.join(sents.select(*SENTENCE, "sent"), list(SENTENCE)).select(
        *SENTENCE,
        "ord",
        F.when(F.col("n") > 1, whole).otherwise(F.col("single.text")).alias("text"),
        F.when(F.col("n") > 1, F.lit("LOC")).otherwise(F.col("single.label")).alias("label"),
        "start",
        "end",
    )


def sentence_tokens(sents: DataFrame, tokens: DataFrame, compat: bool = True) -> DataFrame:
    """A row per sentence with what E7 looks up in it: ``sent``, its word ``ranks`` and its tokens ``toks`` in order."""
    fields = F.struct("tok_idx", "tok") if compat else F.struct("tok_idx", "tok", "start", "end")
    gathered = tokens.groupBy(*SENTENCE).agg(F.sort_array(F.collect_list(fields)).alias("toks"))
    return sents.select(*SENTENCE, "sent", word_ranks(F.col("sent")).alias("ranks")).join(gathered, list(SENTENCE), "left")


def standing(text: Column, chunk_root: Column, compat: bool) -> Column:
    """E7 beside the columns of :func:`sentence_tokens`: the struct ``(anchor, root_idx)`` that stands for ``text``.

    ``chunk_root`` is the root of the first chunk of equal text, or null.
    """
    b = ranked_loc(text, F.col("sent"), F.col("ranks"))["b"]
    last_char = F.position(text, F.col("sent")) + F.length(text) - 2
    toks = F.col("toks")
    token_at = lambda i: F.get(toks, F.array_position(toks["tok_idx"], i).cast("int") - 1)

    def of_place(x: Column) -> Column:
        if compat:
            return F.when(x == 0, F.get(toks, F.size(toks) - 1)).otherwise(token_at(F.greatest(x - 1, F.lit(0)).cast("int")))
        return F.get(F.filter(toks, lambda t: (t["start"] <= x) & (x < t["end"])), F.lit(0))

    # Bound by a lambda, the place is found once and not once per token.
    place = b if compat else F.when(b > 0, last_char)
    token = F.get(F.transform(F.array(place), of_place), F.lit(0))
    chosen = F.transform(F.array(F.coalesce(token, token_at(F.lit(0)))), lambda t: F.struct(
        t["tok"].alias("anchor"), t["tok_idx"].cast("int").alias("root_idx")))
    by_chunk = F.struct(text.alias("anchor"), chunk_root.cast("int").alias("root_idx"))
    return F.when(chunk_root.isNotNull(), by_chunk).otherwise(F.get(chosen, F.lit(0)))


def match_to_chunk(
    texts: DataFrame, chunks: DataFrame, tokens: DataFrame, sents: DataFrame, compat: bool = True
) -> DataFrame:
    """The chunk or token that stands for a text, ``(doc_id, sent_idx, text, anchor, root_idx)``.

    The first chunk of equal text; else the token where the text ends; else the
    first token. ``compat`` takes the white-space index of the text's end as a
    token index, as trained models expect, and the last token for an empty
    text; otherwise the token is the one that covers the text's last character.
    Texts meet chunks in one aggregate, and their sentence in one row.
    """
    key = [*SENTENCE, "text"]
    wanted = texts.select(*key, F.lit(True).alias("wanted"), F.lit(None).cast("int").alias("root_idx"), F.lit(None).cast("long").alias("ord"))
    offered = chunks.select(*key, F.lit(False).alias("wanted"), F.col("root_idx").cast("int"), F.col("ord").cast("long"))
    met = wanted.unionByName(offered).groupBy(*key).agg(
        F.max("wanted").alias("wanted"), F.min_by("root_idx", "ord").alias("chunk_root")
    ).filter("wanted AND text IS NOT NULL")
    return (
        met.join(sentence_tokens(sents, tokens, compat), list(SENTENCE), "left")
        .filter("chunk_root IS NOT NULL OR sent IS NOT NULL")
        .withColumn("found", standing(F.col("text"), F.col("chunk_root"), compat))
        .select(*key, "found.anchor", "found.root_idx")
    )


def end_place(b: Column, last_char: Column, compat: bool) -> Column:
    """Where a located text ends, as :func:`token_places` counts; -1 is the last token."""
    if compat:
        return F.when(b == 0, -1).otherwise(F.greatest(b - 1, F.lit(0)))
    return F.when(b > 0, last_char)


def token_places(tokens: DataFrame, compat: bool) -> DataFrame:
    """Tokens by place, ``(doc_id, sent_idx, place, tok_idx, tok)``: their index, or each character they cover."""
    if not compat:
        covered = F.when(F.col("end") > F.col("start"), F.sequence("start", F.col("end") - 1))
        return tokens.select(*SENTENCE, F.explode(covered).alias("place"), "tok_idx", "tok")
    last = tokens.groupBy(*SENTENCE).agg(F.max(F.struct("tok_idx", "tok")).alias("last"))
    return tokens.select(*SENTENCE, F.col("tok_idx").alias("place"), "tok_idx", "tok").unionByName(
        last.select(*SENTENCE, F.lit(-1).alias("place"), "last.tok_idx", "last.tok")
    )


__all__ = [
    "containments", "dedup_entities", "gathered_pairs", "end_place", "mark_references", "mark_references_in_order", "match_to_chunk",
    "merge_locations", "possessive_core", "sentence_tokens", "standing", "token_places",
]
