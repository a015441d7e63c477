"""Ranks that survive hot groups: ranges of the order first, then within a range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from griyaflow.runtime import stored


def hash_order(col: Column, seed: str = "42") -> Column:
    """Deterministic random order, the same text in any SQL engine: md5(seed || '|' || id)."""
    return F.md5(F.concat(F.lit(f"{seed}|"), col.cast("string")))


def rank_by_hash(df: DataFrame, keys: list[str], order: str, ties: list[str], name: str = "rank") -> DataFrame:
    """Adds the 1-based rank within ``keys`` by the hex text ``order``, then ``ties``.

    The first two hex digits cut every group in 256 ranges; counts of the ranges give offsets and the
    ranking itself runs per range, so a group of a third of all rows is 256 tasks."""
    cut = df.withColumn("_cut", F.substring(order, 1, 2))
    counts = cut.groupBy(*keys, "_cut").agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_cut")) - F.col("_n")
    before = counts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_cut").alias("_k_cut"), upto.alias("_before"))
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col("_cut") == F.col("_k_cut")]
    joined = cut.join(before, same).drop("_k_cut", *[f"_k_{k}" for k in keys])
    place = F.row_number().over(Window.partitionBy(*keys, "_cut").orderBy(order, *ties))
    return joined.withColumn(name, F.col("_before") + place).drop("_cut", "_before")


def global_rank(df: DataFrame, order: list[str], name: str = "rank") -> DataFrame:
    """Adds the 1-based rank over the whole table: range partitions, their sizes as offsets, ranks within."""
    parts = stored(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return parts.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + place).drop("_part", "_before")


def best_per_key(df: DataFrame, keys: list[str], order: Column, last: bool = False) -> DataFrame:
    """The first (or last) row per key by ``order``; combined on the map side, so no group is sorted."""
    pick = F.max_by if last else F.min_by
    whole = F.struct(*df.columns)
    return df.withColumn("_o", order).groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(pick(whole, "_o").alias("_r")).select("_r.*")
