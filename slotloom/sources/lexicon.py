"""Lexicon files: S12, a JSON object from phrase to count."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_lexicon(objects: DataFrame, column: str = "value") -> DataFrame:
    """A JSON text as rows ``(lex_ord, status, n)`` in the file's order."""
    entries = F.map_entries(F.from_json(column, "map<string,bigint>"))
    return objects.select(F.posexplode(entries).alias("lex_ord", "e")).select(
        F.col("lex_ord").cast("long").alias("lex_ord"), F.col("e.key").alias("status"), F.col("e.value").alias("n")
    )


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """A lexicon file; it is one JSON object, so one row."""
    return parse_lexicon(spark.read.text(path, wholetext=True))


def lexicon_json(lexicon: DataFrame) -> DataFrame:
    """The lexicon as one JSON object, in lexicon order, as ``(value)``.

    A JSON object is one text, so its entries meet in one row.
    """
    order = "lex_ord" if "lex_ord" in lexicon.columns else "status"
    entries = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), "status", "n")))
    pairs = F.transform(entries, lambda e: F.struct(e["status"].alias("key"), e["n"].alias("value")))
    return lexicon.agg(F.to_json(F.map_from_entries(pairs)).alias("value"))


def write_lexicon(lexicon: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write the JSON object."""
    lexicon_json(lexicon).write.mode(mode).text(path)
