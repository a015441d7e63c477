"""Joins, upserts, merges and differences of keyed record sets. Order is always a column, never a row's place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from griyaflow.operators.ranking import best_per_key


def upsert(base: DataFrame, changed: DataFrame, key: str, order: str) -> DataFrame:
    """Base rows, replaced by the last changed row of their key; changed rows of new keys are appended, repeats and all.

    Both sides have the same columns. Rows with a null key stay on the base side and are never appended. ``origin`` tells
    base, replaced or appended."""
    cols = [c for c in base.columns if c != key]
    last = best_per_key(changed.filter(F.col(key).isNotNull()), [key], F.col(order), last=True)
    right = last.select(F.col(key).alias("_k"), F.struct(*cols).alias("_r"))
    joined = base.join(right, F.col(key) == F.col("_k"), "left")
    hit = F.col("_k").isNotNull()
    kept = joined.select(key, *[F.when(hit, F.col(f"_r.{c}")).otherwise(F.col(c)).alias(c) for c in cols], F.when(hit, "replaced").otherwise("base").alias("origin"))
    fresh = changed.filter(F.col(key).isNotNull()).join(base.select(key).distinct(), key, "left_anti").select(key, *cols, F.lit("appended").alias("origin"))
    return kept.unionByName(fresh)


def merge_first_wins(sources: list[DataFrame], key: str, order: str) -> DataFrame:
    """Union of sources, one row per key from the earliest source that has it; rows without a key are all kept."""
    tagged = sources[0].withColumn("source_no", F.lit(0))
    for i, s in enumerate(sources[1:], 1):
        tagged = tagged.unionByName(s.withColumn("source_no", F.lit(i)), allowMissingColumns=True)
    first = best_per_key(tagged.filter(F.col(key).isNotNull()), [key], F.struct("source_no", order))
    return first.unionByName(tagged.filter(F.col(key).isNull()))


def change_text(fields: dict[str, tuple[Column, Column]], extra: list[Column]) -> Column:
    """``field: old -> new`` of the fields that differ, joined by `` | ``; empty where none does."""
    shown = lambda c: F.coalesce(c.cast("string"), F.lit("None"))
    parts = [F.when(~old.eqNullSafe(new), F.concat(F.lit(f"{name}: "), shown(old), F.lit(" -> "), shown(new))) for name, (old, new) in fields.items()]
    return F.array_join(F.array_compact(F.array(*parts, *extra)), " | ")


def apply_to_changed(rows: DataFrame, ids: DataFrame, key: str, changes: dict[str, Column]) -> DataFrame:
    """Applies expressions to the rows whose key is in ``ids``; the others pass through unchanged."""
    marked = rows.join(ids.select(key).distinct().withColumn("_hit", F.lit(True)), key, "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    return marked.withColumns({c: F.when(hit, e).otherwise(F.col(c)) for c, e in changes.items()}).withColumn("changed", hit).drop("_hit")
