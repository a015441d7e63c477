"""Distributions, uniqueness and gaps of a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(field, value, n) of several columns, nulls counted, in one pass."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in cols]))
    return df.select(each.alias("e")).groupBy("e.field", "e.value").agg(F.count("*").alias("n")).select("field", "value", "n")


def combo_counts(df: DataFrame, cols: list[str], keep_null: bool = True) -> DataFrame:
    rows = df if keep_null else df.dropna("any", subset=cols)
    return rows.groupBy(*cols).agg(F.count("*").alias("n"))


def pivot_counts(df: DataFrame, rows: list[str], col: str, values: list[str], counted: str) -> DataFrame:
    """Counts of non-null ``counted`` per value of ``col``; absent cells 0, with the row's total."""
    each = [F.count(F.when(F.col(col) == v, F.col(counted))).alias(v) for v in values]
    out = df.groupBy(*rows).agg(*each)
    return out.withColumn("total", reduce(lambda a, b: a + b, [F.col(v) for v in values]))


def missing_combos(df: DataFrame, cols: list[str]) -> DataFrame:
    """Combinations of the columns' values (null among them) that no row has. Only distinct values are crossed."""
    domains = [df.select(c).distinct() for c in cols]
    possible = reduce(lambda a, b: a.join(b), domains)
    have = df.select(*[F.col(c).alias(f"_{c}") for c in cols]).distinct()
    return possible.join(have, [possible[c].eqNullSafe(have[f"_{c}"]) for c in cols], "left_anti")


def key_uniqueness(df: DataFrame, key: str) -> DataFrame:
    """One row: all rows, non-null, null, distinct keys, repeated keys and their rows."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    known = F.col(key).isNotNull()
    return per_key.agg(
        F.sum("n").alias("total_rows"), F.sum(F.when(known, F.col("n")).otherwise(0)).alias("non_null"), F.sum(F.when(~known, F.col("n")).otherwise(0)).alias("null_rows"),
        F.count_if(known).alias("distinct_keys"), F.count_if(known & (F.col("n") > 1)).alias("repeated_keys"), F.sum(F.when(known & (F.col("n") > 1), F.col("n")).otherwise(0)).alias("repeated_rows"),
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def coverage(df: DataFrame, has_image: Column, valid: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Per field: valid, missing and out-of-scope rows among rows with an image, and their shares. valid: field -> (is missing, is valid)."""
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.when(miss, "missing").when(ok, "valid").otherwise("out_of_scope").alias("state")) for f, (miss, ok) in valid.items()]))
    rows = df.select(has_image.alias("has_image"), each.alias("e")).groupBy("e.field").agg(
        F.count("*").alias("all_rows"), F.count_if("has_image").alias("image_rows"),
        *[F.count_if(F.col("has_image") & (F.col("e.state") == s)).alias(s) for s in ("valid", "missing", "out_of_scope")],
    )
    pct = lambda of: F.round(F.coalesce(F.try_divide(F.col("valid") * 100.0, F.col(of)), F.lit(0.0)), 2)
    return rows.select("field", "all_rows", "image_rows", "valid", "missing", "out_of_scope", pct("all_rows").alias("valid_pct_all"), pct("image_rows").alias("valid_pct_image"))


def top(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def distribution_by_split(df: DataFrame, split: str, cols: list[str]) -> DataFrame:
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in cols]))
    return df.select(split, each.alias("e")).filter("e.value is not null").groupBy(split, "e.field", "e.value").agg(F.count("*").alias("n")).select(split, "field", "value", "n")


def change_audit(df: DataFrame, changes: dict[str, tuple[str, str]]) -> DataFrame:
    """(field, old, new, n) where a rewrite changed a value. changes: field -> (old column, new column)."""
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(o).alias("old"), F.col(n).alias("new")) for f, (o, n) in changes.items()]))
    return df.select(each.alias("e")).filter("not (e.old <=> e.new)").groupBy("e.field", "e.old", "e.new").agg(F.count("*").alias("n")).select("field", "old", "new", "n")
