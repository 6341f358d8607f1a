"""Registered queries with their SQL twins, one module per operator family.

Each module holds a ``QUERIES`` dict: name -> (function of (spark, folder), SQL or None).
"""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

FAMILIES = (
    "scoring", "templates", "texts", "spans", "candidates", "features", "training", "models", "lexicons",
)


def load() -> dict[str, tuple[Query, str | None]]:
    """All registered queries."""
    found: dict[str, tuple[Query, str | None]] = {}
    for family in FAMILIES:
        found.update(import_module(f"{__name__}.{family}").QUERIES)
    return found
