"""The corpus pipeline: STAGES applied one after another to ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a table, which is written and read again as the next
one's docs. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotloom.llm import near, packing, repeats, rules
from slotloom.session import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the base rules and the learnt list keep."""
    found = rules.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return rules.judge(docs, found).where("kept").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each class of near duplicates."""
    return near.first_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the words of passages that recur; n_chars follows the text."""
    kept = repeats.drop_repeats(docs)
    named = {c: F.col(f"row.`{c}`") for c in docs.columns if c != "text"} | {"text": F.col("kept_text")}
    if "n_chars" in named:
        named["n_chars"] = F.char_length("kept_text").cast("long")
    return kept.select(*[named[c].alias(c) for c in docs.columns])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences."""
    return packing.pack(docs.select("doc_id", "text")).select(
        "row.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]
# A learnt list and a search have no SQL; tests/llm/test_pipeline.py holds the stages against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
