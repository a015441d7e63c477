"""Same or nearly the same pictures across splits, by a suffix array over their hashes.

A hash is read as a text of 256 bits. Two texts that differ in at most ``max_bits`` places share, at the
same offset, one of ``max_bits + 1`` blocks whole (pigeonhole), so the suffixes that are needed are those
that begin with a block. An entry of the array is the text turned so that its suffix comes first: sorting
entries by block start and turned text is sorting suffixes, and whatever follows is at hand for comparing.
The texts' suffixes are spread by their start and first block and sorted in every partition; where
neighbours have a common prefix of a block or more they form an interval, and pairs of different splits
within it are compared on all their bits. The common prefixes of a pair, over all starts, are the spans
that it shares; merged, they are its coverage.

Most intervals have few members. One with more than ``HOT`` comparisons, such as of flat pictures, is not
compared where it was found: its members go on to a grid of blocks of both splits, one task each, so that no
interval, whatever its size, is work of one task.

Exact copies are one text here, however often they occur, and are expanded into record pairs at the
end only, salted on both sides, so a picture in a third of all rows does not end in one task.

Defined results: hashes that are null, blank, shorter or longer than 64 hex digits, or listed as
placeholders are left out; rows without a split of train, val or test are left out; several equal
pairs of pictures give their record pair once; an empty table gives no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from griyaflow.functions.keys import split_name
from griyaflow.runtime import stored

MAX_BITS = 10
BITS = 256
#: Pairs of an interval are compared in blocks of so many rows, whatever the interval's size.
BLOCK = 2048
SALT = 16
#: Comparisons in an interval beyond which it is spread over a grid of BLOCK x BLOCK.
HOT = 1 << 22


def hash_text(col: Column) -> Column:
    """64 lower-case hex digits, without a leading ``word:``; null where it is none."""
    h = F.regexp_replace(F.lower(F.trim(col)), r"^\w+:", "")
    return F.when(h.rlike("^[0-9a-f]{64}$"), h)


#: The four 64-bit words of a hash; they are its key from the scan on, half as long as its text.
WORDS = ("w0", "w1", "w2", "w3")


def hash_words(h: str) -> list[Column]:
    half = lambda at: F.conv(F.substring(h, at, 8), 16, 10).cast("long")
    return [F.shiftleft(half(16 * k + 1), 32).bitwiseOR(half(16 * k + 9)).alias(w) for k, w in enumerate(WORDS)]


def block_starts(n: int) -> list[tuple[int, int]]:
    """(start, length) of ``n`` blocks that make up the text."""
    cuts = [BITS * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _turned(start: int) -> list[Column]:
    """The text with its suffix from bit ``start`` first."""
    q, r = divmod(start, 64)
    w = [F.col(WORDS[(i + q) % 4]) for i in range(5)]
    return [(w[i] if not r else F.shiftleft(w[i], r).bitwiseOR(F.shiftrightunsigned(w[i + 1], 64 - r))).alias(f"r{i}") for i in range(4)]


def suffixes(hashes: DataFrame, max_bits: int) -> DataFrame:
    """(at, r0..r3): the suffixes of (w0..w3, side) that begin with block k, at being 4 k + side, by partitions and sorted in each."""
    # k and side share a number: an entry is what is shuffled most
    each = [F.struct((F.lit(4 * k) + F.col("side")).cast("byte").alias("at"), *_turned(a)) for k, (a, _) in enumerate(block_starts(max_bits + 1))]
    rows = hashes.withColumn("side", F.col("side").cast("int")).select(F.explode(F.array(*each)).alias("s")).select("s.*")
    k = F.shiftright("at", 2)
    lengths = F.element_at(F.array(*[F.lit(max(0, 64 - n)) for _, n in block_starts(max_bits + 1)]), k + 1)
    # few bytes are much work here, so partitions are asked for by number
    n = int(hashes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, k, F.expr("r0").bitwiseAND(F.call_function("shiftleft", F.lit(-1).cast("long"), lengths))).sortWithinPartitions(k, "r0", "r1", "r2", "r3")


def picture_hashes(df: DataFrame, placeholders: DataFrame, id_col: str = "rec_id") -> DataFrame:
    """Distinct (w0..w3, id, train) of the usable pictures of rows that have a split."""
    rows = df.select(F.col(id_col).alias("id"), split_name(F.col("split")).alias("s"), F.explode(F.array_distinct(F.transform("images.image_hash", hash_text))).alias("h"))
    rows = rows.filter("s is not null and h is not null").select("id", (F.col("s") == "train").alias("train"), *hash_words("h"))
    stand_in = placeholders.select(F.lower(F.trim("image_hash")).alias("h")).filter(F.length("h") == 64).select(*hash_words("h")).distinct()
    return rows.join(stand_in, list(WORDS), "left_anti")


_T, _E = [f"t{i}" for i in range(4)], [f"e{i}" for i in range(4)]
_FOUND = "t0 long, t1 long, t2 long, t3 long, e0 long, e1 long, e2 long, e3 long, bits int, start int, span int"
_HOT = ", k byte, block long, r0 long, r1 long, r2 long, r3 long, side byte"


def _differing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(-1)


def common_prefix(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Leading equal bits of rows of four 64-bit words."""
    d = x ^ y
    first = (d != 0).argmax(1)
    w = d[np.arange(len(d)), first]
    for k in (1, 2, 4, 8, 16, 32):
        w = w | (w >> np.uint64(k))
    return np.where((d == 0).all(1), BITS, 64 * first + 64 - np.bitwise_count(w).astype(np.int64))


def _turned_back(r: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Texts from turned ones, row by row."""
    q, m = start // 64, (start % 64).astype(np.uint64)
    own = np.take_along_axis(r, (np.arange(4) - q[:, None]) % 4, 1)
    left = np.take_along_axis(r, (np.arange(4) - 1 - q[:, None]) % 4, 1)
    m = m[:, None]
    return np.where(m == 0, own, (own >> m) | (left << ((np.uint64(64) - m) & np.uint64(63))))


def _found(t: np.ndarray, e: np.ndarray, start: np.ndarray) -> dict[str, np.ndarray]:
    """Columns of pairs of turned texts that are near."""
    span = np.minimum(common_prefix(t, e), BITS - start)
    back = [_turned_back(x, start).view(np.int64) for x in (t, e)]
    return {**{f"{n}{i}": x[:, i] for n, x in zip("te", back, strict=True) for i in range(4)}, "bits": _differing(t, e).astype(np.int32), "start": start.astype(np.int32), "span": span.astype(np.int32)}


def _intervals(max_bits: int):
    """Scans sorted suffixes (k, block, r0..r3, side): yields near pairs of both sides, and the members of hot intervals."""
    starts_of = np.array([a for a, _ in block_starts(max_bits + 1)])
    shift_of = np.array([max(0, 64 - n) for _, n in block_starts(max_bits + 1)], np.uint64)
    schema = pa.schema([(c.split(" ")[0], {"long": pa.int64(), "int": pa.int32(), "byte": pa.int8()}[c.split(" ")[1]]) for c in (_FOUND + _HOT).split(", ")])

    def batch(made: dict[str, np.ndarray]) -> pa.RecordBatch:
        n = len(next(iter(made.values())))
        return pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) if f.name in made else pa.nulls(n, f.type) for f in schema], schema=schema)

    def scan(k: np.ndarray, block: np.ndarray, r: np.ndarray, side: np.ndarray) -> Iterator[pa.RecordBatch]:
        opens = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (block[1:] != block[:-1])])  # a common prefix shorter than the block
        sizes = np.diff(np.r_[opens, len(k)])
        train, held = (np.add.reduceat((side & bit > 0).astype(np.int64), opens) for bit in (1, 2))
        hot = train * held > HOT
        of = np.repeat(np.arange(len(opens)), sizes)
        left, right = [], []
        small = (sizes <= 16) & ~hot
        for step in range(1, 16):
            i = np.flatnonzero((of[step:] == of[:-step]) & small[of[step:]])
            if not len(i):
                break
            near = _differing(r[i], r[i + step]) <= max_bits
            for x, y in ((i[near], i[near] + step), (i[near] + step, i[near])):
                ok = (side[x] & 1 > 0) & (side[y] & 2 > 0)
                left.append(x[ok])
                right.append(y[ok])
        own = np.flatnonzero((side == 3) & (k == 0))  # the same text on both sides, told once
        left.append(own)
        right.append(own)
        for at in np.flatnonzero(~small & ~hot & (train > 0) & (held > 0)):
            s = np.arange(opens[at], opens[at] + sizes[at])
            t, e = s[side[s] & 1 > 0], s[side[s] & 2 > 0]
            for i in range(0, len(t), BLOCK):
                for j in range(0, len(e), BLOCK):
                    a, b = np.nonzero(_differing(r[t[i : i + BLOCK], None], r[None, e[j : j + BLOCK]]) <= max_bits)
                    apart = t[i + a] != e[j + b]
                    left.append(t[i + a][apart])
                    right.append(e[j + b][apart])
        x, y = np.concatenate(left), np.concatenate(right)
        for i in range(0, len(x), 10_000):
            a, b = x[i : i + 10_000], y[i : i + 10_000]
            yield batch(_found(r[a], r[b], starts_of[k[a]]))
        for at in np.flatnonzero(hot):
            for i in range(opens[at], opens[at] + sizes[at], 10_000):
                s = slice(i, min(i + 10_000, opens[at] + sizes[at]))
                yield batch({"k": k[s], "block": block[s], "side": side[s], **{f"r{c}": r[s, c].view(np.int64) for c in range(4)}})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, ...]] = []
        for b in batches:
            if not b.num_rows:
                continue
            c = [x.to_numpy(zero_copy_only=False) for x in b.columns]
            k, r = c[0] >> 2, np.stack(c[1:5], 1).view(np.uint64)
            cols = (k, (r[:, 0] >> shift_of[k]).astype(np.int64), r, c[0] & 3)
            last = int(np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))[-1:].sum() + 1) if (cols[0][0], cols[1][0]) != (cols[0][-1], cols[1][-1]) else 0
            if last == 0 and (not kept or (kept[0][0][-1], kept[0][1][-1]) == (cols[0][0], cols[1][0])):
                kept.append(cols)  # the open interval waits for the next batch
                continue
            whole = [*kept, tuple(x[:last] for x in cols)]
            yield from scan(*(np.concatenate(x) for x in zip(*whole, strict=True)))
            kept = [tuple(x[last:] for x in cols)]
        if kept:
            yield from scan(*(np.concatenate(x) for x in zip(*kept, strict=True)))

    return run


def _placed(hot: DataFrame) -> DataFrame:
    """(k, block, x, y, bit, r0..r3): the members of hot intervals in the cells of their grids."""
    parts = lambda bit: F.greatest(F.lit(1), F.ceil(F.count_if(F.col("side").bitwiseAND(bit) > 0) / BLOCK)).cast("int")
    sizes = hot.groupBy("k", "block").agg(parts(1).alias("n1"), parts(2).alias("n2"))
    rows = hot.join(sizes, ["k", "block"]).withColumn("h", F.xxhash64("r0", "r1", "r2", "r3"))

    def side(bit: int, own: str, other: str, order: tuple[str, str]) -> DataFrame:
        at = rows.filter(F.col("side").bitwiseAND(bit) > 0).withColumn("own", F.pmod("h", F.col(own)).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        return at.select("k", "block", F.col(order[0]).alias("x"), F.col(order[1]).alias("y"), F.lit(bit).alias("bit"), "r0", "r1", "r2", "r3")

    return side(1, "n1", "n2", ("own", "other")).unionByName(side(2, "n2", "n1", ("other", "own")))


def _grid(hot: DataFrame, max_bits: int) -> DataFrame:
    """Near pairs of hot intervals: each is a grid of blocks of its two sides, a task per cell."""
    starts_of = np.array([a for a, _ in block_starts(max_bits + 1)])

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        r, bit, k = pdf[["r0", "r1", "r2", "r3"]].to_numpy(np.int64).view(np.uint64), pdf["bit"].to_numpy(), int(pdf["k"].iloc[0])
        t, e = r[bit == 1], r[bit == 2]
        out = []
        for i in range(0, len(t), BLOCK):
            for j in range(0, len(e), BLOCK):
                near = sum(np.bitwise_count(t[i : i + BLOCK, None, c] ^ e[None, j : j + BLOCK, c]).astype(np.int16) for c in range(4)) <= max_bits
                a, b = np.nonzero(near)
                out.append(pd.DataFrame(_found(t[i + a], e[j + b], np.full(len(a), starts_of[k]))))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame({c.split(" ")[0]: [] for c in _FOUND.split(", ")})

    n = int(hot.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _placed(hot).repartition(n, "k", "block", "x", "y").groupBy("k", "block", "x", "y").applyInPandas(compare, _FOUND)


def near_hashes(hashes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(t0..t3, e0..e3, bits, covered) of the hashes of the two sides within ``max_bits``, equal ones included; covered counts
    the bits in the spans that they share.

    ``hashes`` is (w0..w3, side) with one row per distinct hash; side bit 1: in train, bit 2: in val or test."""
    seen = stored(suffixes(hashes, max_bits).mapInArrow(_intervals(max_bits), _FOUND + _HOT), "spans")
    found, hot = seen.filter("t0 is not null").select(*_T, *_E, "bits", "start", "span"), seen.filter("k is not null").select("k", "block", "r0", "r1", "r2", "r3", "side")
    if hot.take(1):
        found = found.unionByName(_grid(hot, max_bits))
    # a pair has at most max_bits + 1 spans
    pairs = found.groupBy(*_T, *_E).agg(F.min("bits").alias("bits"), F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("span")).alias("stop")))).alias("spans"))
    merged = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("at")),
        lambda acc, x: F.struct((acc["n"] + F.greatest(F.lit(0), x["stop"] - F.greatest(acc["at"], x["start"]))).alias("n"), F.greatest(acc["at"], x["stop"]).alias("at")),
    )
    return pairs.withColumn("covered", merged["n"]).drop("spans")


def _words_as(name: str) -> list[Column]:
    return [F.col(f"{name}{k}").alias(w) for k, w in enumerate(WORDS)]


def overlapping_hashes(pictures: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    side = F.bit_or(F.when(F.col("train"), 1).otherwise(2)).alias("side")
    return near_hashes(stored(pictures.groupBy(*WORDS).agg(side), "hashes"), max_bits)


def overlapping_pairs(df: DataFrame, placeholders: DataFrame, id_col: str = "rec_id", max_bits: int = MAX_BITS) -> DataFrame:
    """(train_id, eval_id, bits) of record pairs across splits."""
    pictures = stored(picture_hashes(df, placeholders, id_col), "pictures")
    near = stored(overlapping_hashes(pictures, max_bits), "near")
    salt = F.pmod(F.xxhash64("id"), F.lit(SALT)).cast("int")
    t = [f"t{k}" for k in range(4)]
    ev = pictures.filter("not train").join(near.select(*_words_as("e"), *t, "bits"), list(WORDS)).select(F.col("id").alias("eval_id"), *t, "bits", salt.alias("salt"))
    used = pictures.filter("train").join(near.select(*_words_as("t")).distinct(), list(WORDS), "left_semi")
    tr = used.select(*[F.col(w).alias(x) for w, x in zip(WORDS, t, strict=True)], F.col("id").alias("train_id"), F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    return ev.join(tr, [*t, "salt"]).groupBy("train_id", "eval_id").agg(F.min("bits").alias("bits"))


def overlap_classes(df: DataFrame, placeholders: DataFrame, id_col: str = "rec_id", max_bits: int = MAX_BITS) -> DataFrame:
    """(train_hash, eval_hash, bits, covered, n_train, n_eval): pairs of pictures, each standing for all records that hold it. No pair of
    records is formed; a picture's records are its rows of :func:`picture_hashes`."""
    pictures = stored(picture_hashes(df, placeholders, id_col), "pictures")
    counts = stored(pictures.groupBy(*WORDS).agg(F.count_if("train").alias("n_train"), F.count_if(~F.col("train")).alias("n_eval")), "counts")
    text = lambda n: F.concat(*[F.lpad(F.lower(F.hex(f"{n}{k}")), 16, "0") for k in range(4)])
    of = lambda n, c: counts.select(*[F.col(w).alias(f"{n}{k}") for k, w in enumerate(WORDS)], c)
    near = overlapping_hashes(pictures, max_bits).join(of("t", "n_train"), _T).join(of("e", "n_eval"), _E)
    return near.select(text("t").alias("train_hash"), text("e").alias("eval_hash"), "bits", "covered", "n_train", "n_eval")


def overlap_by_split(df: DataFrame, placeholders: DataFrame, id_col: str = "rec_id", max_bits: int = MAX_BITS) -> DataFrame:
    """Per split and source group: records, records that training also holds, exactly or nearly, and the mean share of a picture
    that its shared spans cover, of each record's best covered one.

    No pair of records is formed: a record overlaps as soon as one of its pictures does."""
    pictures = stored(picture_hashes(df, placeholders, id_col), "pictures")
    best = overlapping_hashes(pictures, max_bits).select(*_words_as("e"), "bits", "covered").groupBy(*WORDS).agg(F.min("bits").alias("bits"), F.max("covered").alias("covered"))
    hit = pictures.filter("not train").join(best, list(WORDS)).groupBy("id").agg(F.min("bits").alias("bits"), F.max("covered").alias("covered"))
    rows = df.select(F.col(id_col).alias("id"), split_name(F.col("split")).alias("split"), F.coalesce(F.lower(F.trim("source_group_id")), F.lit("")).alias("source_group"))
    rows = rows.filter("split in ('val', 'test')").join(hit, "id", "left")
    return rows.groupBy("split", "source_group").agg(
        F.count("*").alias("n_records"), F.count("bits").alias("n_overlapping"), F.count_if(F.col("bits") == 0).alias("n_exact"),
        F.avg(F.col("covered") / BITS).alias("mean_coverage"),
    ).filter("n_overlapping > 0")
