"""Text expressions on columns; all of them run inside the JVM."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space when text is stripped or split.
SPACE_CHARS = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
        + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)
SPACE = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

# Pronouns that never fill a slot, and the agency's sign-off line.
PRONOUNS = ("it", "they", "them", "he", "him", "she", "her")
BOILERPLATE = ("Reuter",)

# Words that take the place of missing neighbours of a phrase.
BEFORE_START = ("phi2", "phi1")
AFTER_END = ("omega1", "omega2")


def strip(text: Column) -> Column:
    """Cut white space at both ends."""
    return F.btrim(text, F.lit(SPACE_CHARS))


def one_line(text: Column) -> Column:
    """Newlines become spaces, both ends are stripped."""
    return strip(F.translate(text, "\n", " "))


def ws_tokens(text: Column) -> Column:
    """Tokens between white space, without empty ones."""
    return F.filter(F.split(text, SPACE + "+"), lambda t: t != "")


def strip_article(text: Column, compat: bool = True) -> Column:
    """Cut a leading ``the``; ``compat=False`` cuts only a whole word."""
    prefix = "the" if compat else "the "
    return F.when(F.startswith(text, F.lit(prefix)), F.substr(text, F.lit(4))).otherwise(text)


def strip_punct(token: Column) -> Column:
    """Drop ASCII punctuation."""
    return F.translate(token, string.punctuation, "")


def is_number(token: Column) -> Column:
    """Only digits remain once punctuation is dropped."""
    return F.rlike(strip_punct(token), F.lit(r"^\p{Nd}+$"))


def quote_value(text: Column) -> Column:
    """A template value in quotes, or the no-value mark."""
    return F.coalesce(F.concat(F.lit('"'), strip(text), F.lit('"')), F.lit("---"))


def frequency(text: Column, document: Column) -> Column:
    """non-overlapping occurrences; an empty text occurs between all characters."""
    saved = F.length(document) - F.length(F.replace(document, text, F.lit("")))
    return F.when(F.length(text) == 0, F.length(document) + 1).otherwise(
        (saved / F.length(text)).cast("int")
    )


def sentence_loc(text: Column, sentence: Column) -> Column:
    """struct(a, b), the white-space token range of the first hit; (-1, -1) if absent."""
    at = F.position(text, sentence)
    a = F.size(ws_tokens(F.left(sentence, at - 1)))
    found = F.struct(a.alias("a"), (a + F.size(ws_tokens(text))).alias("b"))
    absent = F.struct(F.lit(-1).alias("a"), F.lit(-1).alias("b"))
    return F.when(at > 0, found).otherwise(absent)


def context_window(loc: Column, tokens: Column) -> Column:
    """two tokens before and two after the range ``loc`` found by :func:`sentence_loc`."""
    a, b, n = loc["a"], loc["b"], F.size(tokens)
    phi2, phi1 = (F.lit(w) for w in BEFORE_START)
    omega1, omega2 = (F.lit(w) for w in AFTER_END)
    before = (
        F.when(a <= 0, F.array(phi2, phi1))
        .when(a == 1, F.array(phi1, F.get(tokens, F.lit(0))))
        .otherwise(F.array(F.get(tokens, a - 2), F.get(tokens, a - 1)))
    )
    after = (
        F.when((b == -1) | (b >= n), F.array(omega1, omega2))
        .when(b + 1 == n, F.array(F.get(tokens, b), omega1))
        .otherwise(F.array(F.get(tokens, b), F.get(tokens, b + 1)))
    )
    return F.concat(before, after)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once: inside a lambda, a plain expression is computed per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_total(sizes: Column, block: int = 256) -> Column:
    """Inclusive running sums of an int array.

    Appending to an array copies it, so one long fold would cost the square of
    the length. Folding blocks and then shifting them by the block totals keeps
    a sentence of a million tokens affordable.
    """
    ints = "array<int>"

    def fold(values: Column) -> Column:
        return F.aggregate(
            values,
            F.array().cast(ints),
            lambda acc, v: F.array_append(acc, F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0)) + v),
        )

    def shifted(blocks: Column, ends: Column) -> Column:
        def shift(sums: Column, k: Column) -> Column:
            return let(
                F.coalesce(F.get(ends, k - 1), F.lit(0)), lambda base: F.transform(sums, lambda v: v + base)
            )

        return F.flatten(F.transform(blocks, shift))

    def in_blocks(sizes: Column) -> Column:
        places = F.sequence(F.lit(0), ((F.size(sizes) - 1) / block).cast("int"))
        cut = F.transform(places, lambda k: fold(F.slice(sizes, k * block + 1, F.lit(block))))
        last = lambda b: F.get(b, F.size(b) - 1)
        return let(cut, lambda blocks: let(fold(F.transform(blocks, last)), lambda ends: shifted(blocks, ends)))

    return let(sizes, lambda s: F.when(F.size(s) <= block, fold(s)).otherwise(in_blocks(s)))


def word_ranks(text: Column) -> Column:
    """For each character the number of white-space tokens that start before it."""
    # A word and the white space behind it share a number, so characters are not looked at one by one.
    words = F.regexp_extract_all(text, F.lit(f"[^{SPACE[1:]}+{SPACE}*"), F.lit(0))
    before = F.length(text) - F.length(F.ltrim(text, F.lit(SPACE_CHARS))) + 1
    within = F.flatten(F.transform(words, lambda w, i: F.array_repeat(i + 1, F.length(w))))
    return F.concat(F.array_repeat(F.lit(0), before), within)


def ranked_loc(text: Column, sentence: Column, ranks: Column, size: Column | None = None) -> Column:
    """F2 by one look into :func:`word_ranks`, for sentences with many phrases.

    Splitting the sentence once per phrase would cost the square of its length. ``size``
    is the number of the text's words, if known.
    """
    size = F.size(ws_tokens(text)) if size is None else size
    at = F.position(text, sentence)
    a = F.get(ranks, at - 1)
    found = F.struct(a.alias("a"), (a + size).alias("b"))
    absent = F.struct(F.lit(-1).alias("a"), F.lit(-1).alias("b"))
    return F.when(at > 0, found).otherwise(absent)
