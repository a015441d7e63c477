"""Connected components by random-mate contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from griyaflow.runtime import drop_stored, stored


def contract(edges: DataFrame) -> DataFrame:
    """(v, label) for every vertex of an undirected edge table (u, v): equal labels within a component.

    In each round every vertex tosses a fresh number and collapses into the neighbour with the smallest
    one below its own; edges are relabelled by joins, loops and repeats vanish. Labels are unwound from
    the last round to the first. An empty table gives no labels; loops and repeated edges change nothing."""
    rounds: list[DataFrame] = []
    now = stored(edges.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    while now.take(1):
        seed = F.lit(len(rounds)).cast("long")
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        toss = lambda c: F.struct(F.xxhash64(c, seed).alias("t"), F.col(c).alias("to"))
        chosen = both.groupBy("u").agg(F.min(toss("v")).alias("m")).filter(F.col("m") < toss("u")).select("u", "m.to")
        moves = stored(chosen, "moves")
        rounds.append(moves)
        other = moves.select(F.col("u").alias("v"), F.col("to").alias("to_v"))
        moved = now.join(moves, "u", "left").select(F.coalesce("to", "u").alias("u"), "v")
        moved = moved.join(other, "v", "left").select("u", F.coalesce("to_v", "v").alias("v")).filter("u <> v")
        after = stored(moved.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
        drop_stored(now)
        now = after
    labels = now.select(F.col("u").alias("v"), F.col("v").alias("label"))  # no row; the types of the ids
    for moves in reversed(rounds):
        later = labels.select(F.col("v").alias("to"), "label")
        through = moves.join(later, "to", "left").select(F.col("u").alias("v"), F.coalesce("label", "to").alias("label"))
        kept = labels.join(moves.select(F.col("u").alias("v")), "v", "left_anti")
        labels = stored(through.unionByName(kept), "labels")
    return labels


def least_label(edges: DataFrame) -> DataFrame:
    """As :func:`contract`, with the least vertex of each component as its label."""
    labels = contract(edges)
    least = labels.groupBy("label").agg(F.min("v").alias("least"))
    least = least.select("label", F.least("least", "label").alias("least"))
    named = labels.unionByName(labels.select(F.col("label").alias("v"), "label")).distinct()
    return named.join(least, "label").select("v", F.col("least").alias("label"))
