"""Queries p9_*: personal information in documents.text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from griyaflow.llm.pii import Model, find_mentions, redact
from griyaflow.runtime import table


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return find_mentions(table(spark, d, "documents"))


def p9_redacted(spark: SparkSession, d: str) -> DataFrame:
    return redact(table(spark, d, "documents"))


def p9_counts(spark: SparkSession, d: str) -> DataFrame:
    return find_mentions(table(spark, d, "documents")).groupBy("pii_type").agg(F.count("*").alias("mentions"), F.count_distinct("doc_id").alias("documents"))


def p9_labelers(spark: SparkSession, d: str) -> DataFrame:
    """Reliability of each labeler as estimated: share of yes on mentions, share of no on others."""
    model = Model(table(spark, d, "documents"))
    return spark.createDataFrame(model.labelers, "pii_type string, labeler string, yes_on_mentions double, no_on_others double, share_of_mentions double, candidates long")


QUERIES = {f.__name__: f for f in (p9_found, p9_redacted, p9_counts, p9_labelers)}
SQL: dict[str, str] = {}
