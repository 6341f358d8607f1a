"""Training rows from noun chunks and gold values: L1-L9."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotloom.functions.matching import nested_sets
from slotloom.functions.text import ranked_loc, strip_punct, word_ranks, ws_tokens
from slotloom.operators.annotate import drop_boilerplate
from slotloom.operators.entities import SENTENCE, containments, end_place, gathered_pairs, token_places
from slotloom.session import stage
from slotloom.slots import NO_ENTITY, NO_SLOT

CHUNK = [*SENTENCE, "ord"]


def gold_by_slot(gold: DataFrame) -> DataFrame:
    """L1: the gold texts of each document and slot, in order."""
    ordered = F.sort_array(F.collect_list(F.struct("place", "text")))
    return gold.groupBy("doc_id", "slot").agg(ordered["text"].alias("texts"))


def overlaps(chunks: DataFrame, gold: DataFrame) -> DataFrame:
    """L2: chunk and gold pairs of a document where one's tokens are all among the other's.

    Only the gold side drops punctuation. A document's chunks and gold texts meet
    in one row. There the tokens are ordered by how many sets of the other side
    hold them, and a set is looked up by its rarest token alone: whoever contains
    it holds that one. So a token of every chunk pairs nothing, unless it is all
    of a gold text. A gold text without tokens has all its tokens in every chunk.
    """
    pairs = gathered_pairs(
        chunks.select(*CHUNK, F.col("text").alias("chunk_text"), F.array_distinct(ws_tokens(F.col("text"))).alias("c")),
        gold.select("doc_id", F.col("text").alias("gold_text"), "slot").distinct().withColumn(
            "g", F.array_distinct(F.transform(ws_tokens(F.col("gold_text")), strip_punct))),
        ["doc_id"], lambda outs, ins: nested_sets(outs["c"], ins["g"]))
    return pairs.select(*CHUNK, "chunk_text", "gold_text", "slot")


def negatives(chunks: DataFrame, pairs: DataFrame) -> DataFrame:
    """L2: chunks that overlap no gold text; overlapping ones are withheld."""
    free = chunks.join(pairs.select(*CHUNK), CHUNK, "left_anti")
    return free.select(*SENTENCE, "text", "root_idx", F.lit(NO_SLOT).alias("label"))


def exact_labels(chunks: DataFrame, pairs: DataFrame) -> DataFrame:
    """L3: per gold text and sentence the first overlapping chunk of equal text gets the slot."""
    equal = pairs.filter("chunk_text = gold_text").join(chunks.select(*CHUNK, "root_idx"), CHUNK)
    return equal.groupBy(*SENTENCE, F.col("gold_text").alias("text"), F.col("slot").alias("label")).agg(
        F.min_by("root_idx", "ord").alias("root_idx")
    ).select(*SENTENCE, "text", "root_idx", "label")


def injected_gold(gold: DataFrame, exact: DataFrame, sents: DataFrame, tokens: DataFrame, compat: bool = True) -> DataFrame:
    """L4: a gold text found in a sentence without an equal chunk becomes a row at its last token.

    ``compat`` takes the white-space index of its end as token index, and the
    last token for an empty text; otherwise the token is the one that covers its
    last character.
    """
    placed = sents.select(*SENTENCE, "sent", word_ranks(F.col("sent")).alias("ranks"))
    found = (
        gold.select("doc_id", "text", F.col("slot").alias("label"))
        .join(placed, "doc_id")
        .filter(F.contains("sent", "text"))
        .select(
            *SENTENCE, "text", "label",
            ranked_loc(F.col("text"), F.col("sent"), F.col("ranks"))["b"].alias("b"),
            (F.position("text", "sent") + F.length("text") - 2).alias("last_char"),
        )
        .join(exact.select(*SENTENCE, "text"), [*SENTENCE, "text"], "left_anti")
    )
    at = found.withColumn("place", end_place(F.col("b"), F.col("last_char"), compat))
    rows = at.join(token_places(tokens, compat), [*SENTENCE, "place"])
    return rows.select(*SENTENCE, "text", F.col("tok_idx").alias("root_idx"), "label")


def substring_labels(chunks: DataFrame, gold: DataFrame) -> DataFrame:
    """The slot of the first gold text that contains the chunk or is contained in it, else none."""
    texts = chunks.select("doc_id", "text").distinct()
    golds = gold.select("doc_id", "text", "slot", "place")
    inside = containments(
        golds.select("doc_id", F.col("text").alias("o_text"), "slot", "place"),
        texts.select("doc_id", F.col("text").alias("needle")), ["doc_id"],
    ).select("doc_id", F.col("needle").alias("text"), "slot", "place")
    around = containments(
        texts.select("doc_id", F.col("text").alias("o_text")),
        golds.select("doc_id", F.col("text").alias("needle"), "slot", "place"), ["doc_id"],
    ).select("doc_id", F.col("o_text").alias("text"), "slot", "place")
    first = inside.unionByName(around).groupBy("doc_id", "text").agg(F.min_by("slot", "place").alias("label"))
    return chunks.drop("label").join(first, ["doc_id", "text"], "left").withColumn(
        "label", F.coalesce("label", F.lit(NO_SLOT))
    )


def entity_labels(rows: DataFrame, ents: DataFrame) -> DataFrame:
    """``ent_label``, the label of the document's equal entity unless it is a reference."""
    plain = ents.filter(~F.col("is_reference")).select("doc_id", "text", F.col("label").alias("ent_label"))
    return rows.join(plain, ["doc_id", "text"], "left").withColumn(
        "ent_label", F.coalesce("ent_label", F.lit(NO_ENTITY))
    )


def training_candidates(
    chunks: DataFrame, gold: DataFrame, sents: DataFrame, tokens: DataFrame, ents: DataFrame, compat: bool = True
) -> DataFrame:
    """Labelled rows ``(doc_id, sent_idx, text, root_idx, label, ent_label)``.

    Overlaps are written once for L2 and L3, and L3's rows for L4.
    """
    kept = drop_boilerplate(chunks)
    pairs = stage(overlaps(kept, gold), "overlaps")
    exact = stage(exact_labels(kept, pairs), "exact_labels")
    rows = negatives(kept, pairs).unionByName(exact).unionByName(injected_gold(gold, exact, sents, tokens, compat))
    return entity_labels(rows, ents)


def row_hash(keys: list[str], seed: int) -> Column:
    """A repeatable hash of a row's keys: the same on every run and engine."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def balance_negatives(rows: DataFrame, keys: list[str], seed: int = 1) -> DataFrame:
    """All labelled rows and exactly as many ``none`` rows, those with the lowest hashes.

    Rows are counted per hash prefix. Whole prefixes below the cut are kept as
    they are, and only the prefix on the cut is ranked, so no task sorts or
    holds the sample. ``keys`` must identify a row; too few ``none`` rows are an error.
    """
    hashed = rows.withColumn("_hash", row_hash(keys, seed)).withColumn("_prefix", F.left("_hash", F.lit(4)))
    none = hashed.filter(F.col("label") == NO_SLOT)
    labelled = hashed.filter(F.col("label") != NO_SLOT)
    wanted = labelled.agg(F.count("*").alias("n")).scalar()
    # At most 65,536 prefixes, so this window and the broadcast below are bounded.
    below = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counted = none.groupBy("_prefix").agg(F.count("*").alias("_n")).select(
        "_prefix", "_n",
        F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_before"),
        F.sum("_n").over(all_rows).alias("_all"),
    ).withColumn("_wanted", wanted)
    enough = F.when(
        F.col("_all") < F.col("_wanted"), F.raise_error(F.lit("fewer rows without slot than labelled rows")).cast("long")
    ).otherwise(F.col("_wanted"))
    cut = counted.withColumn("_wanted", enough).filter("_before < _wanted").drop("_all")
    placed = none.join(F.broadcast(cut), "_prefix")
    whole = placed.filter("_before + _n <= _wanted")
    ranked = (
        placed.filter("_before + _n > _wanted")
        .withColumn("_rank", F.row_number().over(Window.partitionBy("_prefix").orderBy("_hash", *keys)))
        .filter("_before + _rank <= _wanted")
    )
    return (
        labelled.select(*rows.columns)
        .unionByName(whole.select(*rows.columns))
        .unionByName(ranked.select(*rows.columns))
    )


def index_labels(rows: DataFrame) -> DataFrame:
    """``label_idx``, alphabetical codes from 0; only the distinct labels are ranked."""
    codes = rows.select("label").distinct().withColumn(
        "label_idx", (F.row_number().over(Window.orderBy("label")) - 1).cast("int")
    )
    return rows.join(codes, "label")


def split(rows: DataFrame, keys: list[str], seed: int = 0) -> DataFrame:
    """``is_train`` for three quarters of the rows, by hash: repeatable whatever the partitioning."""
    return rows.withColumn("is_train", F.left(row_hash(keys, seed), F.lit(1)) < "c")
