"""Queries p7_* (containers) and p8_* (mixes)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from griyaflow.llm.mixing import mix, mix_report, source_name
from griyaflow.llm.packing import pack, pack_report
from griyaflow.llm.tokens import token_count
from griyaflow.runtime import table


def _packed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, d, "documents").select("doc_id", token_count(F.col("text")).alias("tokens"))
    return pack(docs, table(spark, d, "pack_profiles"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that had to be cut: those of several chunks."""
    placed, _ = _packed(spark, d)
    return placed.groupBy("doc_id", "profile_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id", "profile_id")


def p7_sequences(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d)[0]


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return pack_report(*_packed(spark, d), table(spark, d, "pack_profiles"))


def p7_totals(spark: SparkSession, d: str) -> DataFrame:
    """Per profile: documents, chunks and tokens of all containers, and containers that hold more than they can."""
    placed = _packed(spark, d)[0].join(table(spark, d, "pack_profiles").select("profile_id", "capacity_tokens"), "profile_id")
    bins = placed.groupBy("profile_id", "capacity_tokens", "bin_id").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n"), F.count_if(F.col("chunk_no") == 0).alias("docs"))
    return bins.groupBy("profile_id").agg(F.sum("docs").alias("n_docs"), F.sum("n").alias("n_chunks"), F.sum("t").alias("n_tokens"), F.count_if(F.col("t") > F.col("capacity_tokens")).alias("overfull"))


def _mixed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, d, "documents").select("doc_id", source_name(F.col("source")).alias("source"), token_count(F.col("text")).alias("tokens"))
    return mix(docs, table(spark, d, "mix_plan"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the report whose source has too little."""
    return mix_report(*_mixed(spark, d)).filter("short").select("mix_id", "source")


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d)[0]


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return mix_report(*_mixed(spark, d)).drop("max_repeats")


QUERIES = {f.__name__: f for f in (p7_found, p7_sequences, p7_report, p7_totals, p8_found, p8_mix, p8_report)}
_TOKENS = r"len(regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9]+|[^A-Za-z0-9 \t\r\n]'))"
SQL = {
    "p7_found": f"SELECT doc_id, profile_id FROM (SELECT doc_id, {_TOKENS} AS n FROM documents) JOIN pack_profiles ON n > capacity_tokens",
    "p7_totals": f"SELECT profile_id, count(*) AS n_docs, sum(ceil(n / capacity_tokens))::BIGINT AS n_chunks, sum(n)::BIGINT AS n_tokens, 0::BIGINT AS overfull FROM (SELECT {_TOKENS} AS n FROM documents) JOIN pack_profiles ON n > 0 GROUP BY 1",
    "p8_found": f"""
SELECT mix_id, p.source FROM mix_plan p LEFT JOIN (SELECT lower(trim(source)) AS source, sum({_TOKENS}) AS n FROM documents GROUP BY 1) s ON s.source = p.source
WHERE coalesce(n, 0) * max_repeats < target_share * total_tokens""",
}
