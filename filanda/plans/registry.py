"""All queries of the library outside the llm subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from filanda.plans import catalog, changes, folders, graph, pipeline, quality, texts

MODULES = (changes, texts, graph, pipeline, quality, catalog, folders)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: q for m in MODULES for k, q in m.ORACLES.items()}
