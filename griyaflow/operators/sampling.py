"""Exact proportional samples, group-safe stratified splits, shards and label caps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from griyaflow.operators.fold import admitted_in_order
from griyaflow.operators.ranking import hash_order, rank_by_hash

SPLITS = ("train", "val", "test")


def desired_split_sizes(n: Column) -> dict[str, Column]:
    """Units of a stratum of size ``n`` per split at 0.8 / 0.1 / 0.1: floors, largest remainders (ties in the
    order train, val, test), then at least one each from four units on; 1 is 1/0/0, 2 is 1/0/1, 3 is 1/1/1."""
    t0, m = F.floor(n * 8 / 10), n % 10
    small = F.floor(n / 10)
    rest = n - t0 - 2 * small
    train_first = (n * 8) % 10 >= m
    t = t0 + F.when(train_first & (rest >= 1), 1).otherwise(0)
    v = small + F.when(F.when(train_first, 2).otherwise(1) <= rest, 1).otherwise(0)
    s = small + F.when(F.when(train_first, 3).otherwise(2) <= rest, 1).otherwise(0)
    need = F.when(v == 0, 1).otherwise(0) + F.when(s == 0, 1).otherwise(0)
    big = {"train": t - need, "val": F.greatest(v, F.lit(1)), "test": F.greatest(s, F.lit(1))}
    few = {"train": (1, 1, 1), "val": (0, 0, 1), "test": (0, 1, 1)}
    return {k: F.when(n == 1, few[k][0]).when(n == 2, few[k][1]).when(n == 3, few[k][2]).otherwise(big[k]).cast("long") for k in SPLITS}


def stratified_split(units: DataFrame, unit: str, strata: str, seed: str = "42") -> DataFrame:
    """(unit, strata, new_split): random order within a stratum, cut at the desired sizes. Null strata are left out."""
    rows = units.filter(F.col(strata).isNotNull()).withColumn("_o", hash_order(F.col(unit), seed))
    sizes = rows.groupBy(strata).agg(F.count("*").alias("_n"))
    want = sizes.select(strata, *[c.alias(f"_{k}") for k, c in desired_split_sizes(F.col("_n")).items()])
    ranked = rank_by_hash(rows, [strata], "_o", [unit], "_rank").join(want, strata)
    split = F.when(F.col("_rank") <= F.col("_train"), "train").when(F.col("_rank") <= F.col("_train") + F.col("_val"), "val").otherwise("test")
    return ranked.select(unit, strata, split.alias("new_split"))


def split_units(rows: DataFrame, key: str, order: str, kind: str, strata: Column) -> DataFrame:
    """One row per group of rows: its id, the kind of its first row with one, the stratum of its first row.

    Rows without a key are groups of their own; groups without any kind have a null kind."""
    flat = rows.select(F.coalesce(F.col(key), F.concat(F.lit("__row_"), F.col(order).cast("string"), F.lit("__"))).alias("unit"), F.col(order).alias("_o"), F.col(kind).alias("_k"), strata.alias("_s"))
    first = F.min_by(F.struct("_s"), "_o").alias("first")
    out = flat.groupBy("unit").agg(F.min_by("_k", F.when(F.col("_k").isNotNull(), F.col("_o"))).alias("kind"), first, F.count("*").alias("n_rows"))
    return out.select("unit", "kind", F.col("first._s").alias("stratum"), "n_rows")


def allocation(counts: DataFrame, strata: str, n: str, target: int, cap: bool = True) -> DataFrame:
    """Adds ``quota`` per stratum for a sample of ``target``: floors, then one each by (fraction, size) descending,
    stratum ascending. ``counts`` has a row per stratum, not per record."""
    total = F.sum(n).over(Window.partitionBy())
    want = F.lit(target).cast("long")
    base = F.floor(F.col(n) * want / total)
    frac = (F.col(n) * want) % total
    rows = counts.withColumn("_base", base).withColumn("_frac", frac)
    rows = rows.withColumn("_left", want - F.sum("_base").over(Window.partitionBy()))
    place = F.row_number().over(Window.orderBy(F.desc("_frac"), F.desc(n), F.asc(strata)))
    quota = F.col("_base") + F.when(place <= F.col("_left"), 1).otherwise(0)
    if cap:
        quota = F.least(quota, F.col(n))
    return rows.withColumn("quota", quota).drop("_base", "_frac", "_left")


def proportional_sample(df: DataFrame, strata: str, key: str, target: int, seed: str = "42") -> DataFrame:
    """Exactly ``target`` rows (all, if there are fewer), each stratum in proportion; ``in_sample`` tells which."""
    rows = df.withColumn("_o", hash_order(F.col(key), seed))
    counts = rows.groupBy(strata).agg(F.count("*").alias("_n"))
    quota = allocation(counts, strata, "_n", target).select(strata, "quota")
    ranked = rank_by_hash(rows, [strata], "_o", [key], "_rank").join(quota, strata)
    return ranked.withColumn("in_sample", F.col("_rank") <= F.col("quota")).drop("_o", "_rank", "quota")


def unique_sample(df: DataFrame, group: str, order: str, strata: str, used: DataFrame, target: int, seed: str = "42") -> DataFrame:
    """One record per group id, used ids excluded, quotas without a capacity check, deficits topped up at random."""
    fresh = df.filter(F.col(group).isNotNull()).join(used, group, "left_anti")
    whole = F.struct(*fresh.columns)
    rows = fresh.groupBy(F.col(group).alias("_g")).agg(F.min_by(whole, order).alias("_r")).select("_r.*").withColumn("_o", hash_order(F.col(group), seed))
    quota = allocation(rows.groupBy(strata).agg(F.count("*").alias("_n")), strata, "_n", target, cap=False).select(strata, "quota")
    ranked = rank_by_hash(rows, [strata], "_o", [group], "_rank").join(quota, strata).withColumn("_picked", F.col("_rank") <= F.col("quota"))
    # picked ones first, then the rest in random order: the first ``target`` of them
    again = ranked.withColumn("_o2", F.concat(F.when(F.col("_picked"), "0").otherwise("1"), F.col("_o"))).withColumn("_all", F.lit(1))
    placed = rank_by_hash(again, ["_all"], "_o2", [group], "_place")
    return placed.filter(F.col("_place") <= target).drop("_o", "_o2", "_rank", "quota", "_picked", "_place", "_all")


def shards(df: DataFrame, group: str, order: str, key: str, n: int) -> DataFrame:
    """Round-robin shard (group index + rank in group) mod n; groups by name, rows in the random order of their ``order``."""
    names = df.select(group).distinct().withColumn("_g", F.row_number().over(Window.orderBy(group)) - 1)
    ranked = rank_by_hash(df.withColumn("_o", hash_order(F.col(order))), [group], "_o", [key], "_rank")
    return ranked.join(F.broadcast(names), group).withColumn("shard", F.pmod(F.col("_g") + F.col("_rank") - 1, F.lit(n)).cast("int")).drop("_o", "_g", "_rank")


def label_cap(df: DataFrame, key: str, order: str, labels: str, cap: int, seen: DataFrame | None = None) -> DataFrame:
    """Greedy admission in order: a record enters when its key is new and none of its labels has ``cap`` records yet;
    entering counts for all its labels. A record without a key is never a repeat.

    Each admission depends on all before, so this is an ordered fold: records that cannot matter (no label, key seen
    before) are gone first, and the state is a count per label and the keys of at most cap x labels admitted records."""
    rows = df.filter(F.size(labels) > 0)
    if seen is not None:
        rows = rows.join(seen, key, "left_anti")
    narrow = rows.select(F.col(order).alias("o"), F.col(key).cast("string").alias("k"), F.col(labels).alias("l"))
    admitted = admitted_in_order(narrow, cap)
    return rows.join(admitted.withColumnRenamed("o", order), order, "left_semi")
