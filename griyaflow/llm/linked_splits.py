"""Splits that keep linked records together, by random-mate contraction.

Records are linked by a first key (house) and a second key (source group), also through other
records. Distinct key pairs are aggregated first, so a house or group that holds a third of all rows is
one row here. Every house collapses into its least group; houses of several groups leave edges between
groups. That graph is contracted: in each round every vertex tosses a fresh random number and collapses
into the neighbour with the smallest one below its own; edges are relabelled by joins, loops and
repeats vanish, and rounds go on until no edge is left. Labels are then unwound from the last round to
the first. Components are ordered at random and cut by cumulative weight at the target shares.

Defined results: blank keys and the given null words link nothing; a record with neither key is a
component of its own; split names that are none count as no split but their records are listed with
their component; an empty table gives empty results; repeated rows count each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from griyaflow.functions.keys import blank_to_null, house_key, split_name
from griyaflow.operators.components import contract
from griyaflow.runtime import stored

NULL_GROUPS = ("unknown", "none", "nan")
BUCKETS = 1024
#: A component of at least this share of all rows is placed by itself; there are at most 1 / HEAVY of them.
HEAVY = 0.001
SPLITS = ("train", "val", "test")


def link_house(col: Column) -> Column:
    return blank_to_null(F.regexp_replace(house_key(col), "_(EXT|INT)$", ""))


def link_group(col: Column) -> Column:
    low = blank_to_null(F.lower(col))
    return F.when(~low.isin(*NULL_GROUPS), low)


def _id(col: Column) -> Column:
    """128-bit identity of a key: shorter to shuffle than the key, and without collisions in practice."""
    return F.unhex(F.md5(col))


def linked_keys(df: DataFrame, split_col: str = "split") -> DataFrame:
    """One row per distinct (h, g) key pair: its component, rows and rows per split. Rows without keys are left out."""
    rows = df.select(link_house(F.col("house_id")).alias("h"), link_group(F.col("source_group_id")).alias("g"), split_name(F.col(split_col)).alias("s"))
    counts = [F.count("*").alias("n"), *[F.count_if(F.col("s") == s).alias(f"n_{s}") for s in SPLITS]]
    pairs = stored(rows.filter("h is not null or g is not null").groupBy("h", "g").agg(*counts).withColumn("gid", _id(F.col("g"))), "pairs")
    linking = pairs.filter("h is not null and g is not null").select("h", "gid")
    roots = linking.groupBy("h").agg(F.min("gid").alias("root"), F.max("gid").alias("last"))
    bridges = linking.join(roots.filter("root <> last"), "h").filter("gid <> root")
    labels = contract(bridges.select(F.col("root").alias("u"), F.col("gid").alias("v")))
    of_house = roots.join(labels.withColumnRenamed("v", "root"), "root", "left").select("h", F.coalesce("label", "root").alias("label"))
    with_house = pairs.filter("h is not null").join(of_house, "h", "left").withColumn("component", F.coalesce("label", _id(F.concat(F.lit("h:"), "h"))))
    group_only = pairs.filter("h is null").join(labels.withColumnRenamed("v", "gid"), "gid", "left").withColumn("component", F.coalesce("label", "gid"))
    cols = ["h", "g", "n", *[f"n_{s}" for s in SPLITS], "component"]
    return stored(with_house.select(*cols).unionByName(group_only.select(*cols)), "components")


def _sets(keys: DataFrame) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("n", *[f"n_{s}" for s in SPLITS])]
    return keys.groupBy("component").agg(*sums)


def _parted(sets: DataFrame) -> DataFrame:
    return sets.filter(reduce(lambda a, b: a + b, [(F.col(f"n_{s}") > 0).cast("int") for s in SPLITS]) > 1)


def parted_sets(df: DataFrame) -> DataFrame:
    """Linked sets that hold more than one split, with their rows per split."""
    return _parted(_sets(linked_keys(df))).select(F.lower(F.hex("component")).alias("component"), F.col("n").alias("n_rows"), *[f"n_{s}" for s in SPLITS])


def parted_rows(df: DataFrame, id_col: str = "rec_id") -> DataFrame:
    """Ids of the rows in a linked set that holds more than one split."""
    keys = linked_keys(df)
    bad = keys.join(_parted(_sets(keys)).select("component"), "component", "left_semi").select(_pair_id().alias("pid"))
    return _keyed(df, id_col).join(bad, "pid", "left_semi").select(id_col)


def _pair_id() -> Column:
    return _id(F.concat_ws("\u0001", F.coalesce("h", F.lit("\u0002")), F.coalesce("g", F.lit("\u0002"))))


def _keyed(df: DataFrame, id_col: str) -> DataFrame:
    rows = df.select(id_col, link_house(F.col("house_id")).alias("h"), link_group(F.col("source_group_id")).alias("g"))
    return rows.filter("h is not null or g is not null").select(id_col, _pair_id().alias("pid"))


def assign_splits(df: DataFrame, shares: list[tuple[str, float]], id_col: str = "rec_id", seed: int = 42) -> DataFrame:
    """(id, component, new_split): linked rows share a split, splits take their shares of the rows."""
    total_share = sum(s for _, s in shares) or 1.0
    shares = [(n, s / total_share) for n, s in shares]
    keys = linked_keys(df)
    alone_rows = df.filter(link_house(F.col("house_id")).isNull() & link_group(F.col("source_group_id")).isNull())
    alone = alone_rows.select(id_col, _id(F.concat(F.lit("r:"), F.col(id_col).cast("string"))).alias("component"))
    sets = stored(keys.groupBy("component").agg(F.sum("n").alias("n")).unionByName(alone.groupBy("component").agg(F.count("*").alias("n"))), "sets")
    total = sets.agg(F.sum("n")).first()[0] or 0
    left = {n: s * total for n, s in shares}
    heavy = sets.filter(F.col("n") >= max(2.0, HEAVY * total)).orderBy(F.desc("n"), "component").limit(int(1 / HEAVY)).collect()
    placed = []
    for row in heavy:
        best = max(left, key=lambda n: left[n])
        left[best] -= row["n"]
        placed.append((row["component"], best))
    rest_total = max(1e-9, sum(max(0.0, x) for x in left.values()))
    spark = df.sparkSession
    by_hand = spark.createDataFrame(placed, "component binary, new_split string")
    order = F.xxhash64("component", F.lit(seed).cast("long"))
    light = sets.join(F.broadcast(by_hand.select("component")), "component", "left_anti").withColumn("o", order).withColumn("b", F.pmod(F.shiftrightunsigned("o", 54), F.lit(BUCKETS)))
    # cumulative weight over all sets: sums of 1024 ranges of the order first, then within a range
    sums = light.groupBy("b").agg(F.sum("n").alias("w"))
    upto = sums.select("b", (F.sum("w").over(Window.orderBy("b")) - F.col("w")).alias("before"), F.sum("w").over(Window.partitionBy()).alias("all"))
    within = F.sum("n").over(Window.partitionBy("b").orderBy("o", "component"))
    at = (F.col("before") + within - F.col("n") / 2) / F.col("all")
    cut, upper, names = F.lit(shares[-1][0]), 0.0, []
    for n, _ in shares[:-1]:
        upper += max(0.0, left[n]) / rest_total
        names.append((n, upper))
    for n, u in reversed(names):
        cut = F.when(at < u, F.lit(n)).otherwise(cut)
    by_weight = light.join(F.broadcast(upto), "b").select("component", cut.alias("new_split"))
    chosen = stored(by_weight.unionByName(by_hand), "chosen")
    of_pair = keys.join(chosen, "component").select(_pair_id().alias("pid"), "component", "new_split")
    linked = _keyed(df, id_col).join(of_pair, "pid").select(id_col, "component", "new_split")
    return linked.unionByName(alone.join(chosen, "component").select(id_col, "component", "new_split")).withColumn("component", F.lower(F.hex("component")))
