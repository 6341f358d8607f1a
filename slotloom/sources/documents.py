"""Documents and manifests: S1, S2."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotloom.functions.text import one_line, strip
from slotloom.sources.templates import read_lines


def base_name(path: Column) -> Column:
    """The file name of a path written with slashes or backslashes."""
    return F.substring_index(F.translate(path, "\\", "/"), "/", -1)


def normalise_documents(docs: DataFrame) -> DataFrame:
    """S1 on a table: ``text`` on one line, stripped; ``raw`` keeps the text as it was."""
    return docs.withColumn("raw", F.col("text")).withColumn("text", one_line(F.col("text")))


def read_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per file, ``(doc_id, path, raw, text)``; the id is the file name."""
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("doc_id"),
        F.col("_metadata.file_path").alias("path"),
        F.col("value").alias("text"),
    )
    return normalise_documents(files)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The listed paths in order, ``(ord, path, doc_id)``; ``ord`` is the line's place (file, split, line)."""
    lines = read_lines(spark, path).withColumn("path", strip(F.col("line"))).filter("path <> ''")
    return parse_manifest(lines)


def parse_manifest(lines: DataFrame) -> DataFrame:
    """S2 on placed lines that carry ``path`` and ``pos``, and ``file`` and ``block`` if they come from files.

    A scan takes large splits first, so ``pos`` orders the lines of one split only.
    """
    place = F.struct("file", "block", "pos") if "file" in lines.columns else F.col("pos").cast("long")
    return lines.select(
        place.alias("ord"), "path", base_name(F.col("path")).alias("doc_id")
    )


def documents_in(docs: DataFrame, manifest: DataFrame) -> DataFrame:
    """The manifest's documents; a repeated entry repeats its document."""
    ids = docs.withColumn("doc_id", F.col("doc_id").cast("string")).drop("path")
    return manifest.select("ord", "path", "doc_id").join(ids, "doc_id")
