"""Template files: S3 read, S3b continuation lines, S4 answer keys, S5 pairing, S6-S9 write.

A template collection is a long table ``(tmpl_ord, doc_id, slot, val_ord, value)``: one header
row per record (``slot`` is null) and one row per filled value. ``val_ord`` grows with the
lines of the collection; only its order matters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotloom.session import ranged, stage
from slotloom.slots import NO_VALUE, SLOTS

# The keys that start a template file's lines, a continuation line, and a quoted string.
KEYS = ("text", *SLOTS)
MORE_LINE = r"(?s)^\s+(\w.*)$"
LINE_SPACE = " \t\n\x0b\f\r"
QUOTED = r'"([^"]*)"'


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of text files with their place: ``(file, block, pos, line)``.

    Files are split like any text scan. ``block`` is where the split starts in
    its file and ``pos`` grows inside a split, so together they order a file's
    lines without reading it in one task.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").alias("line"),
    )


def parse_templates(lines: DataFrame, strict_compat: bool = False) -> DataFrame:
    """Template records from placed lines.

    State is carried down a file in two levels: inside a split by a window, and
    between splits by a window over one summary row per split. No task holds
    more lines than one split.

    ``strict_compat`` keeps three quirks: a continuation after ACQUIRED is
    dropped, one after STATUS goes to SELLER, and one after TEXT is dropped in
    either mode.
    """
    space = F.lit(LINE_SPACE)

    def named(name: Column) -> Column:
        # a key ends in a colon and white space; a line without key may go on with the value above it
        is_key = name.isin(*KEYS) & F.substr("line", F.length(name) + 2, F.lit(1)).isin(*LINE_SPACE)
        more = F.when(F.left("line", F.lit(1)).isin(*LINE_SPACE), F.rtrim(F.regexp_extract("line", MORE_LINE, 1), space))
        return F.struct(
            F.when(is_key, name).alias("key"),
            F.when(is_key, F.trim(F.substr("line", F.length(name) + 2), space)).alias("rest"),
            F.when(~is_key & (more != ""), more).alias("more"),
        )

    # Bound by a lambda, a line's key is found once; written, since the lines are read twice below.
    parts = F.transform(F.array(F.lower(F.substring_index("line", ":", 1))), named)
    told = F.filter(parts, lambda x: x["key"].isNotNull() | x["more"].isNotNull())
    keyed = stage(lines.select("file", "block", "pos", F.inline(told)), "keyed_lines")

    is_head = F.col("key") == "text"
    head_pos = F.when(is_head, F.col("pos"))
    key_pos = F.when(F.col("key").isNotNull(), F.col("pos"))
    splits = stage(keyed.groupBy("file", "block").agg(
        F.count(head_pos).alias("heads"),
        F.count("*").alias("lines"),
        F.max_by("rest", head_pos).alias("last_id"),
        F.max_by("key", key_pos).alias("last_key"),
    ), "splits")
    # a row per split: ranges of splits are summed one by one, and only the ranges' totals meet in one task
    splits = ranged(splits, "split_ranges", "file", "block")
    earlier_ranges = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = splits.groupBy("_range").agg(F.sum("heads").alias("heads"), F.sum("lines").alias("lines")).select(
        "_range",
        F.coalesce(F.sum("heads").over(earlier_ranges), F.lit(0)).alias("heads_before"),
        F.coalesce(F.sum("lines").over(earlier_ranges), F.lit(0)).alias("lines_before"),
    )
    earlier = Window.partitionBy("_range").orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = splits.join(totals, "_range").select(
        "file",
        "block",
        (F.col("heads_before") + F.coalesce(F.sum("heads").over(earlier), F.lit(0))).alias("head_base"),
        (F.col("lines_before") + F.coalesce(F.sum("lines").over(earlier), F.lit(0))).alias("line_base"),
        F.last("last_id", ignorenulls=True).over(above).alias("above_id"),
        F.last("last_key", ignorenulls=True).over(above).alias("above_key"),
    )
    in_split = Window.partitionBy("file", "block").orderBy("pos")
    down = in_split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    under = F.coalesce(F.last("key", ignorenulls=True).over(down), F.col("above_key"))
    placed = (
        keyed.join(carried, ["file", "block"])
        .select(
            (F.col("head_base") + F.count(head_pos).over(down) - 1).alias("tmpl_ord"),
            (F.col("line_base") + F.row_number().over(in_split) - 1).alias("val_ord"),
            F.coalesce(
                F.last(F.when(is_head, F.col("rest")), ignorenulls=True).over(down),
                F.col("above_id"),
            ).alias("doc_id"),
            under.alias("under"),
            "key",
            F.coalesce("rest", "more").alias("value"),
        )
        .filter("doc_id IS NOT NULL")
    )
    continued = F.when(F.col("under") != "text", F.col("under"))
    if strict_compat:
        continued = F.when(F.col("under") == "status", F.lit("seller")).when(
            ~F.col("under").isin("text", "acquired"), F.col("under")
        )
    named = F.when(F.col("key") != "text", F.col("key"))
    is_record = F.col("key").eqNullSafe("text")
    is_empty = F.col("key").isNotNull() & (F.col("value") == NO_VALUE)
    return (
        placed.withColumn("slot", F.when(F.col("key").isNull(), continued).otherwise(named))
        .filter(is_record | (F.col("slot").isNotNull() & ~is_empty))
        .select(
            "tmpl_ord",
            "doc_id",
            "slot",
            "val_ord",
            F.when(~is_record, F.col("value")).alias("value"),
        )
    )


def read_templates(
    spark: SparkSession, path: str | list[str], strict_compat: bool = False
) -> DataFrame:
    """S3: template files (a gold file, an output file or many key files) as a long table."""
    return parse_templates(read_lines(spark, path), strict_compat)


def records(templates: DataFrame) -> DataFrame:
    """The header rows: one ``(tmpl_ord, doc_id)`` per record."""
    return templates.filter("slot IS NULL").select("tmpl_ord", "doc_id")


def values(templates: DataFrame) -> DataFrame:
    """The filled values."""
    return templates.filter("slot IS NOT NULL")


def answer_keys(templates: DataFrame) -> DataFrame:
    """Every quoted alternative of every slot, ``(doc_id, slot, val_ord, alt_idx, text, is_primary)``.

    The primary value of a slot is the first alternative of its last line.
    """
    quoted = values(templates).select(
        "doc_id",
        "slot",
        "val_ord",
        F.posexplode(F.regexp_extract_all("value", F.lit(QUOTED), F.lit(1))).alias("alt_idx", "text"),
    )
    last_line = quoted.groupBy("doc_id", "slot").agg(F.max("val_ord").alias("last_line"))
    return quoted.join(last_line, ["doc_id", "slot"]).select(
        "doc_id",
        "slot",
        "val_ord",
        "alt_idx",
        "text",
        ((F.col("val_ord") == F.col("last_line")) & (F.col("alt_idx") == 0)).alias("is_primary"),
    )


def gold_texts(keys: DataFrame) -> DataFrame:
    """One slot per ``(doc_id, text)``: first place in order, slot of the last line that names it."""
    place = F.struct("val_ord", "alt_idx")
    return keys.groupBy("doc_id", "text").agg(
        F.max_by("slot", place).alias("slot"), F.min(place).alias("place")
    )


def pair_docs_with_keys(docs: DataFrame, keys: DataFrame, check: bool = True) -> DataFrame:
    """Documents that have a key, with the key's ``doc_id``; a key without document is an error.

    Key ids may carry the ``.key`` file ending. A document without key is dropped.
    """
    wanted = keys.select(
        F.regexp_replace(F.col("doc_id").cast("string"), r"\.key$", "").alias("doc_id")
    ).distinct()
    found = docs.withColumn("doc_id", F.col("doc_id").cast("string"))
    if check:
        lost = wanted.join(found.select("doc_id"), "doc_id", "left_anti").take(5)
        if lost:
            raise ValueError(f"answer keys without document, e.g. {[r.doc_id for r in lost]}")
    return found.join(wanted, "doc_id")


def template_lines(docs: DataFrame, filled: DataFrame, separator: str = " ") -> DataFrame:
    """The lines of a template file, ``(ord, line_no, val_ord, line)``.

    ``docs`` is ``(ord, doc_id)``, ``filled`` is ``(ord, slot, val_ord, value)``.
    Each record has a header, a line per slot value (the no-value mark for an
    empty slot) and a separator.
    """
    # A record's values meet its header in one row, and the lines are laid out there.
    held = filled.filter("slot IS NOT NULL").groupBy("ord").agg(
        F.collect_list(F.struct("slot", F.coalesce("val_ord", F.lit(0)).alias("val_ord"), "value")).alias("held"))
    first = F.lit(0).cast(filled.schema["val_ord"].dataType)

    def laid(line_no: int, line: Column) -> Column:
        return F.array(F.struct(F.lit(line_no).alias("line_no"), first.alias("val_ord"), line.alias("line")))

    def slot_lines(line_no: int, slot: str) -> Column:
        own = F.filter("held", lambda v: v["slot"] == slot)
        shown = lambda value: F.concat(F.lit(f"{slot.upper()}: "), F.coalesce(value, F.lit(NO_VALUE)))
        lines = F.transform(own, lambda v: F.struct(
            F.lit(line_no).alias("line_no"), v["val_ord"].alias("val_ord"), shown(v["value"]).alias("line")))
        # no values at all is null
        return F.when(F.size(own) > 0, lines).otherwise(laid(line_no, shown(F.lit(None).cast("string"))))

    parts = F.concat(
        laid(0, F.concat(F.lit("TEXT: "), F.col("doc_id").cast("string"))),
        *[slot_lines(i + 1, s) for i, s in enumerate(SLOTS)],
        laid(len(SLOTS) + 1, F.lit(separator)),
    )
    return docs.select("ord", "doc_id").join(held, "ord", "left").select("ord", F.inline(parts))


def blank_template_lines(docs: DataFrame, separator: str = " ") -> DataFrame:
    """The all-empty baseline for ``docs`` = ``(ord, doc_id)``."""
    nothing = F.lit(None).cast("string")
    none = docs.select(
        "ord", nothing.alias("slot"), F.lit(0).alias("val_ord"), nothing.alias("value")
    ).limit(0)
    return template_lines(docs, none, separator)


def concat_templates(templates: DataFrame, separator: str = "") -> DataFrame:
    """All records as the lines of one gold file."""
    docs = records(templates).select(F.col("tmpl_ord").alias("ord"), "doc_id")
    filled = values(templates).select(F.col("tmpl_ord").alias("ord"), "slot", "val_ord", "value")
    return template_lines(docs, filled, separator)


def write_templates(lines: DataFrame, path: str, mode: str = "errorifexists", files: int | None = None) -> None:
    """Write lines in order; range partitions keep the part files in order too.

    ``files=1`` gives the single file a scorer reads, for output that fits one.
    """
    ordered = lines.orderBy("ord", "line_no", "val_ord").select("line")
    (ordered.coalesce(files) if files else ordered).write.mode(mode).text(path)


def keys_by_document(templates: DataFrame) -> DataFrame:
    """The key lines of each document, cut at records: ``(doc_id, ord, line_no, val_ord, line)``."""
    docs = records(templates).select(F.col("tmpl_ord").alias("ord"), "doc_id")
    lines = concat_templates(templates).filter(F.col("line_no") <= len(SLOTS))
    return lines.join(docs, "ord").select("doc_id", "ord", "line_no", "val_ord", "line")


def write_keys_by_document(templates: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One folder of key lines per document."""
    (
        keys_by_document(templates)
        .repartition("doc_id")
        .sortWithinPartitions("doc_id", "ord", "line_no", "val_ord")
        .select("doc_id", "line")
        .write.mode(mode)
        .partitionBy("doc_id")
        .text(path)
    )


__all__ = [
    "answer_keys", "blank_template_lines", "concat_templates", "gold_texts", "pair_docs_with_keys",
    "keys_by_document", "parse_templates", "read_lines", "read_templates", "records", "template_lines", "values",
    "write_keys_by_document", "write_templates",
]
