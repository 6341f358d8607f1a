"""Sentences, tokens, named entities and noun chunks: T1, T3-T7.

Annotation is an input contract: any tagger that yields these tables will do.

* tokens: ``doc_id, sent_idx, tok_idx, tok, pos, dep, head_idx, start, end``
* spans: ``doc_id, sent_idx, ord, text, label, start, end, root_idx``

:func:`annotate_with` plugs a tagger in. The rules below are the default. They
work inside a document's row with array expressions, so annotating a corpus
needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from slotloom.functions.text import BOILERPLATE, PRONOUNS, SPACE, SPACE_CHARS, let, running_total, strip
from slotloom.slots import NO_ENTITY

# What a tagger of one's own gives for a sentence: field names and types, in order.
TOKEN_FIELDS = {"tok": "string", "pos": "string", "dep": "string", "head_idx": "int", "start": "int", "end": "int"}
SPAN_FIELDS = {"text": "string", "label": "string", "start": "int", "end": "int", "root_idx": "int"}
NESTED = {"toks": TOKEN_FIELDS, "ents": SPAN_FIELDS, "chunks": SPAN_FIELDS}

# Fixed values of the default rules: abbreviations that end in a full stop, and word classes.
ABBREVIATIONS = ("Corp", "Inc", "Ltd", "Co", "Cos", "Bros", "Mr", "Mrs", "Ms", "Dr", "St", "No", "Jr", "Sr")
WORD_CLASSES = {
    "DET": ("the", "a", "an", "this", "that", "these", "those", "its", "their"),
    "PRON": ("it", "they", "them", "he", "him", "she", "her", "who", "which"),
    "ADP": ("of", "in", "to", "for", "with", "by", "on", "at", "from", "into"),
    "CCONJ": ("and", "or", "but"),
    "AUX": ("is", "are", "was", "were", "be", "been", "has", "have", "had", "will", "would"),
    "VERB": ("said", "says", "say", "buy", "buys", "bought", "sell", "sells", "sold", "hold", "holds", "held"),
}
MONEY_UNITS = ("$", "dlr", "dlrs", "dollar", "dollars", "mln", "million", "billion", "pounds", "yen", "francs", "marks")
DEPENDENCIES = {
    "PUNCT": "punct", "NUM": "nummod", "DET": "det", "ADP": "prep", "CCONJ": "cc", "AUX": "aux",
    "ADV": "advmod", "ADJ": "amod", "VERB": "conj",
}
NOMINAL = ("DET", "ADJ", "NUM", "NOUN", "PROPN", "PRON")
CHUNK_CORE = ("NOUN", "PROPN", "PRON")

MASK = "\ue000"
INNER_STOP = r"\.([^\s.!?])"
ABBREVIATED = rf"(^|[\s(\x22'])({'|'.join(ABBREVIATIONS)}|(?:[A-Z]\x{{e000}})*[A-Z])\."
SENTENCE = r"[^.!?]+[.!?]*"

# Characters per wanted sentence that are split first; a text without enough sentences there is split whole.
LIKELY = 256
WORD = r"[\p{L}\p{N}](?:[\p{L}\p{N}.'&-]*[\p{L}\p{N}])?"
OTHER = "[^" + SPACE[1:-1] + r"\p{L}\p{N}]"
PIECE = f"({SPACE}*)({WORD}|{OTHER})"


def sentences(docs: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` sentences of each document, ``(doc_id, sent_idx, sent)``.

    A full stop inside a token or after an abbreviation or initial does not end
    a sentence. The list is cut before it is exploded, so no shuffle is needed.
    """
    # What follows a sentence's end and a character of the next one can't change the sentence.
    whole = _split(F.col("text"))
    found = whole if n > 1000 else let(
        _split(F.left("text", F.lit(LIKELY * (n + 1)))), lambda s: F.when(F.size(s) > n, s).otherwise(whole))
    return docs.select("doc_id", F.posexplode(F.slice(found, 1, n)).alias("sent_idx", "sent"))


def _split(text: Column) -> Column:
    masked = F.regexp_replace(F.regexp_replace(text, INNER_STOP, MASK + "$1"), ABBREVIATED, "$1$2" + MASK)
    found = F.transform(
        F.regexp_extract_all(masked, F.lit(SENTENCE), F.lit(0)),
        lambda s: strip(F.translate(s, MASK, ".")),
    )
    return F.filter(found, lambda s: s != "")


def word_tokens(text: Column) -> Column:
    """Words and single marks; marks inside a word stay with it."""
    return F.regexp_extract_all(text, F.lit(PIECE), F.lit(2))


def _ends_with(text: Column, *endings: str) -> Column:
    return reduce(or_, [F.endswith(text, F.lit(e)) for e in endings])


def _pos(tok: Column, low: Column) -> Column:
    """T3 rule for a token and its lower-case form: word class by closed lists, then by shape and ending.

    Words of the lists are letters alone, so they come first, by one look into a set; patterns are tried where an ending fits.
    """
    listed = reduce(lambda rule, x: rule.when(low.isin(*x[1]), x[0]), WORD_CLASSES.items(), F)
    return (
        F.when(low.isin(*[w for words in WORD_CLASSES.values() for w in words]), listed)
        .when(~F.rlike(tok, F.lit(r"[\p{L}\p{N}]")), "PUNCT")
        .when(F.rlike(tok, F.lit(r"^[0-9][0-9.]*$")), "NUM")
        .when(_ends_with(tok, "ed", "ing", "ise", "ize") & F.rlike(tok, F.lit("^[a-z].*(ed|ing|ise|ize)$")), "VERB")
        .when(F.rlike(tok, F.lit(r"^\p{Lu}")), "PROPN")
        .when(F.endswith(tok, F.lit("ly")), "ADV")
        .when(_ends_with(tok, "ous", "ful", "ive", "able", "al", "ic"), "ADJ")
        .otherwise("NOUN")
    )


def annotate(sents: DataFrame) -> DataFrame:
    """Each sentence with arrays ``pieces`` and ``toks`` (tok, pos, dep, head_idx, start, end).

    The first verb is the root. Other tokens hang on the last verb before them,
    else on the root; verbs hang on the root.
    """
    # A piece without the white space in front is its word, as word_tokens finds it.
    cut = sents.select("*", F.regexp_extract_all("sent", F.lit(PIECE), F.lit(0)).alias("pieces")).select(
        "*", F.transform("pieces", lambda p: F.ltrim(p, F.lit(SPACE_CHARS))).alias("words"))
    tagged = cut.select("*", F.transform("words", lambda w: F.lower(w)).alias("lows")).select(
        "*",
        F.zip_with("words", "lows", _pos).alias("tags"),
        running_total(F.transform("pieces", lambda p: F.length(p))).alias("ends"),
    ).select(
        "*",
        F.greatest(F.array_position("tags", "VERB").cast("int") - 1, F.lit(0)).alias("root"),
        F.filter(
            F.transform("tags", lambda t, i: F.when(t == "VERB", i)), lambda i: i.isNotNull()
        ).alias("verbs"),
    )
    verbs = F.col("verbs")

    def until(k: Column | int) -> Column:
        """The place of a verb by its number, or the sentence's end."""
        return F.coalesce(F.get(verbs, F.lit(k) if isinstance(k, int) else k), F.size("tags"))

    # For each place the last verb up to it, or else the root: the same up to the next verb.
    last = F.concat(
        F.array_repeat("root", until(0)), F.flatten(F.transform(verbs, lambda v, k: F.array_repeat(v, until(k + 1) - v))))

    def head(tag: Column, verb: Column) -> Column:
        return F.when(tag == "VERB", F.col("root")).otherwise(verb)

    def dependency(tag: Column, i: Column) -> Column:
        rule = F.when(i == F.col("root"), "ROOT")
        for pos, dep in DEPENDENCIES.items():
            rule = rule.when(tag == pos, dep)
        return rule.when(i < F.col("root"), "nsubj").otherwise("dobj")

    rows = F.arrays_zip(
        F.col("words").alias("tok"),
        F.col("tags").alias("pos"),
        F.transform("tags", dependency).alias("dep"),
        F.zip_with("tags", last, head).alias("head_idx"),
        F.zip_with("ends", "words", lambda e, w: e - F.length(w)).alias("start"),
        F.col("ends").alias("end"),
    )
    return tagged.select(*sents.columns, "pieces", rows.alias("toks"))


def token_rows(annotated: DataFrame) -> DataFrame:
    """The token table of annotated sentences.

    An outer explode, then a filter on its output: for a plain explode of a
    column the optimizer infers a filter on the array and pushes it, with the
    whole annotation inlined, below the projections that compute it once.
    """
    rows = annotated.select("doc_id", "sent_idx", F.posexplode_outer("toks").alias("tok_idx", "t"))
    return rows.filter("tok_idx IS NOT NULL").select("doc_id", "sent_idx", "tok_idx", "t.*")


def annotate_with(sents: DataFrame, tagger: Callable[[list[str]], list[dict]]) -> DataFrame:
    """T3-T5 with a tagger of your own: each sentence with arrays ``toks``, ``ents`` and ``chunks`` (``NESTED``).

    ``tagger`` takes a list of sentences and gives a dict of the three lists for
    each; it travels to the executors, where a batch of sentences is one call. A
    sentence stays one row, so nothing is grouped again. A null sentence is
    passed as an empty one. Wrong numbers of sentences, other fields, values of
    another type and heads or roots outside the sentence are errors.
    """
    plain = {"string": pa.string(), "int": pa.int32()}
    nested = {name: dict(fields) for name, fields in NESTED.items()}
    kinds = {name: pa.list_(pa.struct([(f, plain[t]) for f, t in fields.items()])) for name, fields in nested.items()}

    def checked(found: dict) -> dict:
        if set(found) != set(nested):
            raise ValueError(f"a sentence needs {sorted(nested)}, not {sorted(found)}")
        for name, fields in nested.items():
            for item in found[name]:
                if set(item) != set(fields):
                    raise ValueError(f"{name} need {sorted(fields)}, not {sorted(item)}")
                place = item["head_idx" if name == "toks" else "root_idx"]
                if place is None or not 0 <= place < len(found["toks"]):
                    raise ValueError(f"{name}: no token {place} in the sentence")
        return found

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("sent").to_pylist()]
            tagged = [checked(f) for f in tagger(texts)]
            if len(tagged) != len(texts):
                raise ValueError(f"{len(texts)} sentences gave {len(tagged)} annotations")
            arrays = [pa.array([f[name] for f in tagged], kinds[name]) for name in nested]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, *nested])

    schema = StructType(list(sents.schema.fields))
    for name, fields in nested.items():
        schema = schema.add(name, DataType.fromDDL(f"array<struct<{','.join(f'`{f}`:{t}' for f, t in fields.items())}>>"))
    return sents.mapInArrow(run, schema)


def annotated(sents: DataFrame, tagger: Callable[[list[str]], list[dict]] | None = None) -> DataFrame:
    """Sentences annotated by ``tagger``, or by the default rules."""
    return annotate(sents) if tagger is None else annotate_with(sents, tagger)


def _given_spans(annotated: DataFrame, column: str) -> DataFrame:
    rows = annotated.select("doc_id", "sent_idx", F.posexplode_outer(column).alias("ord", "s")).filter("ord IS NOT NULL")
    return rows.select("doc_id", "sent_idx", "ord", "s.text", "s.label", "s.start", "s.end", "s.root_idx")


def _runs(flags: Column) -> Column:
    """Maximal runs of true flags as structs ``(first, last)`` of 0-based places."""
    n = F.size(flags)
    no = F.array(F.lit(False))
    before = F.concat(no, F.slice(flags, F.lit(1), n))
    after = F.concat(F.slice(flags, F.lit(2), n), no)

    def places(other: Column) -> Column:
        edge = F.zip_with(flags, other, lambda here, there: here & ~there)
        return F.filter(F.transform(edge, lambda e, i: F.when(e, i)), lambda i: i.isNotNull())

    # ``before`` is one longer than the flags; its surplus end pairs with null and is dropped.
    return F.zip_with(places(before), places(after), lambda a, b: F.struct(a.alias("first"), b.alias("last")))


def _spans(
    annotated: DataFrame, flag: Callable[[Column], Column], keep: Callable[[Column], Column], label: str
) -> DataFrame:
    """Runs of flagged tokens that hold a kept one, as span rows.

    Spans are finished inside the row, so exploding them copies no token array.
    """

    def part(values: str, run: Column) -> Column:
        return F.slice(F.col(values), run["first"] + 1, run["last"] - run["first"] + 1)

    def span(run: Column) -> Column:
        return F.struct(
            run["first"].alias("ord"),
            strip(F.array_join(part("pieces", run), "")).alias("text"),
            F.lit(label).alias("label"),
            F.get(F.col("toks"), run["first"])["start"].alias("start"),
            F.get(F.col("toks"), run["last"])["end"].alias("end"),
            run["last"].alias("root_idx"),
        )

    runs = F.filter(
        _runs(F.transform("toks", flag)), lambda run: F.exists(part("toks", run), keep)
    )
    return annotated.select("doc_id", "sent_idx", F.inline(F.transform(runs, span)))


def _ruled_entities(annotated: DataFrame) -> DataFrame:
    names = _spans(
        annotated, lambda t: t["pos"] == "PROPN", lambda t: F.lit(True), "ORG"
    )
    sums = _spans(
        annotated,
        lambda t: (t["pos"] == "NUM") | F.lower(t["tok"]).isin(*MONEY_UNITS),
        lambda t: t["pos"] == "NUM",
        "MONEY",
    ).filter(F.rlike(F.lower("text"), F.lit(r"[^0-9.\s]")))
    return names.unionByName(sums)


def entities(annotated: DataFrame, gazetteer: DataFrame | None = None) -> DataFrame:
    """T4: entity spans: a tagger's own, or by rule. Capitalised runs are ORG, amounts with a unit are MONEY.

    ``gazetteer`` is ``(text, label)`` with distinct texts; it overrides the label of equal texts.
    """
    found = _given_spans(annotated, "ents") if "ents" in annotated.columns else _ruled_entities(annotated)
    if gazetteer is None:
        return found
    known = gazetteer.select("text", F.col("label").alias("known"))
    return found.join(known, "text", "left").select(
        "doc_id", "sent_idx", "ord", "text", F.coalesce("known", "label").alias("label"), "start", "end", "root_idx"
    )


def noun_chunks(annotated: DataFrame) -> DataFrame:
    """T5: a tagger's own, or maximal runs of nominal tokens that hold a noun, name or pronoun; the last token is the root."""
    if "chunks" in annotated.columns:
        return _given_spans(annotated, "chunks")
    return _spans(
        annotated,
        lambda t: t["pos"].isin(*NOMINAL),
        lambda t: t["pos"].isin(*CHUNK_CORE),
        NO_ENTITY,
    )


def drop_boilerplate(chunks: DataFrame) -> DataFrame:
    """Without the agency's sign-off."""
    return chunks.filter(~F.col("text").isin(*BOILERPLATE))


def drop_pronouns(chunks: DataFrame) -> DataFrame:
    """Without lower-case personal pronouns."""
    return chunks.filter(~F.col("text").isin(*PRONOUNS))
