"""Difference of two copies of a table by invertible Bloom lookup tables.

Each side is reduced to its latest row per key, then to (key hash, row hash). Keys fall into buckets;
per bucket and side an IBLT of three sub-tables holds count, XOR of key hashes, XOR of row hashes and
XOR of checksums. The sides exchange only these cells: subtracted, equal rows cancel, and peeling
reveals the keys that differ. Their rows are then fetched from both sides and compared field by field.
A bucket whose table was too small for its differences is built again with twice the cells, alone,
until it peels; beyond MOST_CELLS, where rows repeated on one side cancel themselves, its rows are compared
directly. So the result is exact whatever the share of differences.

Defined results: rows with a null or blank key are left out; the latest row is the one with the
greatest order columns, nulls lowest; columns other than the named ones are not looked at; two empty
sides have no differences.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from griyaflow.runtime import stored

KEYS_PER_BUCKET = 8192
START_CELLS = 4096
#: A bucket's table holds all of its keys' rows of both sides well before this; one that has not peeled then never will.
MOST_CELLS = 16 * KEYS_PER_BUCKET
SUB_TABLES = 3

_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def xxhash64_longs(*cols: np.ndarray) -> np.ndarray:
    """XXH64 of 64-bit columns chained as Spark's ``xxhash64`` chains them (seed 42)."""
    seed = np.uint64(42)
    with np.errstate(over="ignore"):
        for c in cols:
            h = np.asarray(seed + _P5 + np.uint64(8), dtype=np.uint64)
            h = h ^ (_rotl(np.asarray(c).astype(np.int64).view(np.uint64) * _P2, 31) * _P1)
            h = _rotl(h, 27) * _P1 + _P4
            h = (h ^ (h >> np.uint64(33))) * _P2
            h = (h ^ (h >> np.uint64(29))) * _P3
            seed = h ^ (h >> np.uint64(32))
    return np.asarray(seed).view(np.int64)


def latest_rows(df: DataFrame, key: Column, order: list[Column], fields: dict[str, Column]) -> DataFrame:
    """(k, the named fields) of the row with the greatest ``order`` per non-null key; map-side combined."""
    flat = df.select(key.alias("k"), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]).alias("o"), F.struct(*[c.alias(n) for n, c in fields.items()]).alias("v"))
    best = flat.filter("k is not null").groupBy("k").agg(F.max_by("v", F.struct("o", F.xxhash64("v"))).alias("v"))
    return best.select("k", "v.*")


def _hashed(side: DataFrame, names: list[str]) -> DataFrame:
    # a hash skips nulls: a flag per field tells them from values and fields from one another
    return side.withColumns({"kh": F.xxhash64("k"), "rh": F.xxhash64(*[x for n in names for x in (F.col(n).isNull(), F.col(n))])})


def _cells(side: DataFrame, n_buckets: int, cells: int, sign: int) -> DataFrame:
    """One side's tables: the only exchange is of (kh, rh), after it every bucket is local."""
    width = cells // SUB_TABLES
    base = side.select("kh", "rh", F.pmod("kh", F.lit(n_buckets)).alias("bucket")).repartition("bucket")
    spread = F.explode(F.array(*[F.pmod(F.xxhash64("kh", "rh", F.lit(j).cast("long")), F.lit(width)) + j * width for j in range(SUB_TABLES)]))
    return (
        base.withColumn("chk", F.xxhash64("rh", "kh")).withColumn("cell", spread).groupBy("bucket", "cell")
        .agg((F.count("*") * sign).alias("n"), F.bit_xor("kh").alias("kx"), F.bit_xor("rh").alias("rx"), F.bit_xor("chk").alias("cx"))
    )


def peel(cell: np.ndarray, n: np.ndarray, kx: np.ndarray, rx: np.ndarray, cx: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """Entries (key hash, row hash, side +1/-1) of a subtracted table; whether it peeled to nothing."""
    width = cells // SUB_TABLES
    count = np.zeros(cells, np.int64)
    keys, rows, checks = (np.zeros(cells, np.int64) for _ in range(3))
    np.add.at(count, cell, n)
    for at, x in ((keys, kx), (rows, rx), (checks, cx)):
        np.bitwise_xor.at(at, cell, x)
    out_k, out_r, out_s = [], [], []
    while True:
        pure = np.flatnonzero((np.abs(count) == 1) & (checks == xxhash64_longs(rows, keys)))
        if not len(pure):
            break
        found = pd.DataFrame({"k": keys[pure], "r": rows[pure], "s": count[pure]}).drop_duplicates()
        k, r, s = (found[c].to_numpy() for c in "krs")
        out_k.append(k)
        out_r.append(r)
        out_s.append(s)
        chk = xxhash64_longs(r, k)
        for j in range(SUB_TABLES):
            at = np.mod(xxhash64_longs(k, r, np.full(len(k), j)), width) + j * width
            np.subtract.at(count, at, s)
            for held, x in ((keys, k), (rows, r), (checks, chk)):
                np.bitwise_xor.at(held, at, x)
    done = not (count.any() or keys.any() or rows.any() or checks.any())
    empty = [np.zeros(0, np.int64)]
    return np.concatenate(out_k or empty), np.concatenate(out_r or empty), np.concatenate(out_s or empty), done


def _peeler(cells: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        k, _, _, done = peel(*(pdf[c].to_numpy() for c in ("cell", "n", "kx", "rx", "cx")), cells)
        if not done:  # nothing of a table that did not empty is used
            return pd.DataFrame({"bucket": [key[0]], "kh": [0], "done": [False]})
        return pd.DataFrame({"bucket": key[0], "kh": k, "done": True})

    return run


def differing_keys(left: DataFrame, right: DataFrame, n_keys: int, start_cells: int = START_CELLS) -> DataFrame:
    """Key hashes (kh) whose rows differ between two (k, kh, rh) tables, revealed by peeling."""
    n_buckets = max(1, -(-n_keys // KEYS_PER_BUCKET))
    cells, todo_l, todo_r, parts, failed = start_cells // SUB_TABLES * SUB_TABLES, left, right, [], None
    while True:
        both = _cells(todo_l, n_buckets, cells, 1).unionByName(_cells(todo_r, n_buckets, cells, -1))
        peeled = stored(both.groupBy("bucket").applyInPandas(_peeler(cells), "bucket long, kh long, done boolean"), "peeled")
        parts.append(peeled.filter("done").select("kh"))
        failed = peeled.filter("not done").select("bucket")
        if not failed.take(1):
            return reduce(DataFrame.unionByName, parts).distinct()
        if cells >= MOST_CELLS:  # rows repeated on one side cancel in every cell and never peel: these buckets are compared row by row
            sides = [t.withColumn("bucket", F.pmod("kh", F.lit(n_buckets))).join(failed, "bucket", "left_semi").select("kh", "rh", F.lit(s).alias("s")) for t, s in ((todo_l, 1), (todo_r, -1))]
            parts.append(sides[0].unionByName(sides[1]).groupBy("kh", "rh").agg(F.sum("s").alias("s")).filter("s <> 0").select("kh"))
            return reduce(DataFrame.unionByName, parts).distinct()
        todo_l, todo_r = (t.withColumn("bucket", F.pmod("kh", F.lit(n_buckets))).join(failed, "bucket", "left_semi").drop("bucket") for t in (left, right))
        cells *= 2


def field_differences(left: DataFrame, right: DataFrame, fields: list[str], start_cells: int = START_CELLS) -> DataFrame:
    """Rows (k, in_left, in_right, per field f: f_left, f_right) of the keys that differ.

    ``left`` and ``right`` are tables (k, fields...) with one row per key."""
    sides = [stored(_hashed(s, fields), n) for s, n in ((left, "main"), (right, "copy"))]
    n_keys = max(s.count() for s in sides)
    keys = stored(differing_keys(*sides, n_keys, start_cells), "differing")
    fetched = [s.join(keys, "kh", "left_semi").select("k", F.lit(True).alias(f"in_{n}"), *[F.col(f).alias(f"{f}_{n}") for f in fields]) for s, n in zip(sides, ("left", "right"), strict=True)]
    return fetched[0].join(fetched[1], "k", "full_outer")


def difference_report(diff: DataFrame, key_name: str, fields: dict[str, str], left_name: str = "main", right_name: str = "mirror") -> DataFrame:
    """(key, field_name, kind) with both values as text. ``fields`` maps a compared field to its reported name."""
    entries = [
        F.when(F.col("in_right").isNull(), F.struct(F.lit(key_name).alias("field_name"), F.lit(f"missing_in_{right_name}").alias("kind"), F.col("k").alias("left_value"), F.lit(None).cast("string").alias("right_value")))
        .when(F.col("in_left").isNull(), F.struct(F.lit(key_name).alias("field_name"), F.lit(f"missing_in_{left_name}").alias("kind"), F.lit(None).cast("string").alias("left_value"), F.col("k").alias("right_value")))
    ]
    both = F.col("in_left").isNotNull() & F.col("in_right").isNotNull()
    for f, name in fields.items():
        lv, rv = F.col(f"{f}_left"), F.col(f"{f}_right")
        entries.append(F.when(both & ~lv.eqNullSafe(rv), F.struct(F.lit(name).alias("field_name"), F.lit("differs").alias("kind"), lv.cast("string").alias("left_value"), rv.cast("string").alias("right_value"))))
    return diff.select(F.col("k").alias(key_name), F.explode(F.array_compact(F.array(*entries))).alias("e")).select(key_name, "e.*")
