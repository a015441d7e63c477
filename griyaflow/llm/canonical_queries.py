"""Queries p6_*: hand-typed materials and the reference list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from griyaflow.llm.canonical import canonical_mentions
from griyaflow.runtime import table


def _mapped(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return canonical_mentions(table(spark, d, "sample_15"), table(spark, d, "material_ref"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _mapped(spark, d)[0].select("rec_id", "image_pos", "component", "ref_id")


def p6_map(spark: SparkSession, d: str) -> DataFrame:
    """Every distinct value with the entry that it means, its likeness and how often it was typed."""
    return _mapped(spark, d)[1].select("component", "value", "ref_id", "name", "jaccard", "n_mentions")


def p6_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Values that mean no entry, with their mentions."""
    return _mapped(spark, d)[1].filter("ref_id = 0").select("component", "value", "n_mentions")


QUERIES = {f.__name__: f for f in (p6_found, p6_map, p6_unmatched)}
SQL: dict[str, str] = {}
