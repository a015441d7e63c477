"""Writers: JSON lines with nulls kept, CSV manifests, swapped outputs, split files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_json_lines(df: DataFrame, path: str, append: bool = False) -> None:
    """JSON lines; null members are written, and ``append`` adds to what is there."""
    df.write.mode("append" if append else "errorifexists").option("ignoreNullFields", False).json(path)


def write_manifest(df: DataFrame, path: str, columns: list[str]) -> None:
    """CSV with a header and fixed columns; what is missing is empty text."""
    have = set(df.columns)
    df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in have else F.lit("").alias(c) for c in columns]).write.option("header", True).option("emptyValue", "").csv(path)


def write_lines(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).cast("string").alias("value")).write.text(path)


def write_swapped(df: DataFrame, path: str) -> None:
    """Replaces ``path``: written beside it, then renamed, so a reader of the old data may be the source."""
    spark = df.sparkSession
    hpath = spark._jvm.org.apache.hadoop.fs.Path
    new, old = f"{path}.new", f"{path}.old"
    fs = hpath(path).getFileSystem(spark._jsc.hadoopConfiguration())
    df.write.mode("overwrite").parquet(new)
    fs.delete(hpath(old), True)
    if fs.exists(hpath(path)):
        fs.rename(hpath(path), hpath(old))
    fs.rename(hpath(new), hpath(path))
    fs.delete(hpath(old), True)


def write_shards(df: DataFrame, shard: str, path: str) -> DataFrame:
    """One folder per shard; returns the manifest (shard, n)."""
    df.write.partitionBy(shard).option("ignoreNullFields", False).json(path)
    return df.groupBy(shard).agg(F.count("*").alias("n"))
