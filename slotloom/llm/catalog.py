"""All registered queries of this subpackage: name -> (function of (spark, folder), SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from slotloom.llm import queries_pages, queries_text


def load() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]]:
    return {**queries_text.QUERIES, **queries_pages.QUERIES}
