"""All queries of the core and the SQL that tells their results independently."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.plans import files, problems, reference, texts

_MODULES = (reference, files, texts, problems)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for m in _MODULES for name, query in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in getattr(m, "SQL", {}).items()}


def flagship(spark: SparkSession, directory: str) -> DataFrame:
    return reference.coverage(spark, directory)
