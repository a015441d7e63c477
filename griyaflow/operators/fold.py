"""Ordered folds: steps that depend on all steps before, over a range-sorted table."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from griyaflow.runtime import stored


class CapState:
    """Records per label and the keys admitted: at most cap x labels of them."""

    def __init__(self, cap: int):
        self.cap, self.count, self.keys, self.full = cap, {}, set(), set()

    def admit(self, key: str | None, labels: list[str]) -> bool:
        if key is not None and key in self.keys or any(x in self.full for x in labels):
            return False
        self.keys.add(key)
        for x in labels:
            self.count[x] = self.count.get(x, 0) + 1
            if self.count[x] >= self.cap:
                self.full.add(x)
        return True


def admitted_in_order(rows: DataFrame, cap: int) -> DataFrame:
    """Orders (o) of the rows (o, k, l) that a greedy cap admits.

    The rows are range-partitioned and sorted; the driver walks the ranges in order and holds the state only. Of a
    range it fetches the rows that the state so far does not exclude already, streamed, so that once all labels are
    full nothing is fetched any more."""
    spark = rows.sparkSession
    parts = stored(rows.repartitionByRange("o").sortWithinPartitions("o").withColumn("p", F.spark_partition_id()), "ranges")
    state, out = CapState(cap), []
    for p in [r["p"] for r in parts.select("p").distinct().orderBy("p").collect()]:
        full = F.array(*[F.lit(x) for x in sorted(state.full)]).cast("array<string>")
        live = parts.filter((F.col("p") == p) & ~F.arrays_overlap("l", full)).orderBy("o")
        for r in live.toLocalIterator():
            if state.admit(r["k"], r["l"]):
                out.append((r["o"],))
    return spark.createDataFrame(out, rows.select("o").schema)


def cap_by_brute_force(rows: Iterator[tuple], cap: int) -> list:
    state = CapState(cap)
    return [o for o, k, labels in sorted(rows, key=lambda r: r[0]) if labels and state.admit(k, labels)]

