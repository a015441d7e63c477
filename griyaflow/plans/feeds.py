"""Queries of sources and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from griyaflow.sources.records import rows_per_file
from griyaflow.streaming.events import read_stream, run_to_end, windowed_counts


def source_files(spark: SparkSession, d: str) -> DataFrame:
    """Rows per file of a scan over several files."""
    return rows_per_file(spark.read.parquet(f"{d}/customer.parquet")).unionByName(rows_per_file(spark.read.parquet(f"{d}/orders.parquet")))


def event_windows(spark: SparkSession, d: str) -> DataFrame:
    """Daily counts per event type, computed as a stream to its end."""
    return run_to_end(windowed_counts(read_stream(spark, d, "events")))


QUERIES = {f.__name__: f for f in (source_files, event_windows)}
SQL = {
    "source_files": "SELECT 'customer.parquet' AS file, count(*) AS n FROM customer UNION ALL SELECT 'orders.parquet', count(*) FROM orders",
    "event_windows": "SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n, sum(round(value * 100)::BIGINT)::BIGINT AS cents FROM events GROUP BY 1, 2",
}
