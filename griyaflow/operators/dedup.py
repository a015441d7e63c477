"""Near-duplicate removal over embeddings: pairs, clusters, winners, cascade."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from griyaflow.operators.components import least_label
from griyaflow.runtime import stored

#: Bounds of the pivots that cut the space in cells, the root of the vectors' number; a bounded sample, every vector is placed.
LEAST_PIVOTS, MOST_PIVOTS = 64, 4096
BLOCK = 1024


def _unit(vectors: pd.Series) -> np.ndarray:
    x = np.array(vectors.tolist(), dtype=np.float64)
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(n == 0, 1, n)


def similar_pairs(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """(a, b, score) with a < b of all pairs of cosine at least ``threshold``: an exact metric-space join.

    Every vector has a home, the cell of its nearest pivot, and visits each cell that a vector within the threshold's
    angle could live in (triangle inequality of angles). Within a cell, home blocks meet blocks of all its vectors, so
    no task holds a whole cell. A high threshold, as for duplicates, leaves few visits; a low one costs more, but
    nothing is lost. Null vectors have no pair; zero vectors are like nothing."""
    rows = df.filter(F.col(vec_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))
    n_pivots = min(MOST_PIVOTS, max(LEAST_PIVOTS, math.isqrt(rows.count())))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(n_pivots).toPandas()
    if not len(sample):
        return rows.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(0.0).alias("score")).limit(0)
    pivots, reach = _unit(sample["v"]), 2 * math.acos(max(-1.0, min(1.0, threshold))) + 1e-9

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            angle = np.arccos(np.clip(_unit(pdf["v"]) @ pivots.T, -1, 1))
            home = angle.argmin(1)
            at, cell = np.nonzero(angle <= angle.min(1, keepdims=True) + reach)
            yield pd.DataFrame({"cell": cell, "home": cell == home[at], "id": pdf["id"].to_numpy()[at], "v": pdf["v"].to_numpy()[at]})

    placed = stored(rows.mapInPandas(place, f"cell long, home boolean, id {df.schema[id_col].dataType.simpleString()}, v array<float>"), "cells")
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    blocked = placed.join(sizes, "cell").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    homes = blocked.filter("home").withColumn("other", every).select("cell", F.col("block").alias("x"), F.col("other").alias("y"), F.lit(True).alias("home"), "id", "v")
    guests = blocked.withColumn("other", every).select("cell", F.col("other").alias("x"), F.col("block").alias("y"), F.lit(False).alias("home"), "id", "v")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = pdf[pdf["home"]], pdf[~pdf["home"]]
        if not len(a) or not len(b):
            return pd.DataFrame({"a": pdf["id"][:0], "b": pdf["id"][:0], "score": np.zeros(0)})
        score = _unit(a["v"]) @ _unit(b["v"]).T
        i, j = np.nonzero(score >= threshold)
        ai, bj = a["id"].to_numpy()[i], b["id"].to_numpy()[j]
        first = ai < bj  # each pair once, from the home of its smaller id
        return pd.DataFrame({"a": ai[first], "b": bj[first], "score": score[i, j][first]})

    kind = df.schema[id_col].dataType.simpleString()
    return homes.unionByName(guests).groupBy("cell", "x", "y").applyInPandas(compare, f"a {kind}, b {kind}, score double")


def nearest_pairs(pairs: DataFrame, k: int = 5) -> DataFrame:
    """Pairs that are among the ``k`` most similar of either end; ties by the other's id."""
    both = pairs.select("a", "b", "score", F.col("a").alias("at"), F.col("b").alias("other")).unionByName(pairs.select("a", "b", "score", F.col("b").alias("at"), F.col("a").alias("other")))
    rank = F.row_number().over(Window.partitionBy("at").orderBy(F.desc("score"), "other"))
    return both.withColumn("rank", rank).filter(F.col("rank") <= k).select("a", "b", "score").distinct()


def clusters(pairs: DataFrame) -> DataFrame:
    """(id, cluster) of the pairs' ends; a cluster is named by its least id."""
    return least_label(pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))).select(F.col("v").alias("id"), F.col("label").alias("cluster"))


# House types in the order in which their pictures are kept.
KEPT_FIRST = ("multi", "single_interior_only", "single_exterior_only")


def retain_order(house_type: Column, card: Column) -> Column:
    """Less is kept first: by house type, then records with a card number."""
    rank = F.coalesce(*[F.when(house_type == t, i) for i, t in enumerate(KEPT_FIRST)], F.lit(99))
    return F.struct(rank.alias("type"), card.isNull().alias("crawled"))


def winners(members: DataFrame, records: DataFrame, priority: str | Column) -> DataFrame:
    """(cluster, winner, size): the member of least priority, then least id. Members without a record can't win, nor do they count."""
    rows = members.join(records.select("id", (F.col(priority) if isinstance(priority, str) else priority).alias("_p")), "id")
    return rows.groupBy("cluster").agg(F.min(F.struct("_p", "id")).alias("w"), F.count("*").alias("size")).select("cluster", F.col("w.id").alias("winner"), "size")


def losers(members: DataFrame, won: DataFrame) -> DataFrame:
    """(cluster, winner, loser): what each cluster drops, a row each, however large it is."""
    return members.join(won.select("cluster", "winner"), "cluster").filter("id <> winner").select("cluster", "winner", F.col("id").alias("loser"))


def cluster_pairs(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """(cluster, a, b, score): the pairs that made each cluster; both ends of a pair are in the same one."""
    return pairs.join(members.select(F.col("id").alias("a"), "cluster"), "a").select("cluster", "a", "b", "score")


def cascade(records: DataFrame, members: DataFrame, won: DataFrame, houses: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Pictures left (id, house, ..) and houses (house, before, left): losers go, houses without a picture go.

    With ``houses`` (house, house_type) and a ``view`` in the records, houses without any picture from the start are told too, and
    ``type_after`` is what a house is: one of both views that is left with a single picture takes its view's type, a removed one has none."""
    left = records.join(losers(members, won).select(F.col("loser").alias("id")), "id", "left_anti")
    before = records.groupBy("house").agg(F.count("*").alias("before"))
    if houses is None:
        after = left.groupBy("house").agg(F.count("*").alias("n"))
        return left, before.join(after, "house", "left").select("house", "before", F.coalesce("n", F.lit(0)).alias("left"))
    after = left.groupBy("house").agg(F.count("*").alias("n"), F.min("view").alias("view"))
    rows = houses.join(before, "house", "left").join(after, "house", "left").select("house", "house_type", "view", F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("n", F.lit(0)).alias("left"))
    single = F.when(F.col("view") == "exterior", "single_exterior_only").when(F.col("view") == "interior", "single_interior_only").otherwise(F.col("house_type"))
    kind = F.when(F.col("left") == 0, None).when((F.col("left") == 1) & (F.col("house_type") == "multi"), single).otherwise(F.col("house_type"))
    return left, rows.withColumn("type_after", kind).drop("view")


def first_of_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Ids of the first record of each text; texts are compared by their SHA-256, so long ones are not shuffled.
    Records without text are all kept."""
    keyed = df.select(id_col, F.sha2(text_col, 256).alias("h"))
    return keyed.filter("h is not null").groupBy("h").agg(F.min(id_col).alias(id_col)).select(id_col).unionByName(keyed.filter("h is null").select(id_col))
