"""Filling containers of fixed capacity: the configuration LP over the length histogram.

Texts longer than the capacity are cut into full chunks and a rest; nothing else is cut. Only the
histogram of lengths, at most ``capacity`` counts, is solved. The LP asks for the fewest bins, in fractions
of configurations (multisets of lengths that fit), that cover all counts. Its first columns are the bins of
best-fit decreasing. Multiplicative weights then hold a price per length; a knapsack DP finds the configuration
of the highest price, which gets bins, and the prices of its lengths fall by the share of their counts that it
covers. Counts stay fixed: they are covered several times over, and the bins are scaled back to once. That is
an upper bound; counts x prices over the price of the best configuration is a lower one. The rounds end when
the bounds are within ``GAP``, or when as many rounds as PATIENCE times the lengths narrowed nothing; both are
reported. Rounding takes the whole bins of each configuration, then single bins by falling fractions while their items are
there, then best-fit for the rest; of this and the first columns the fewer bins are taken. The bins reach the
items as runs of ranks within a length, so the work on items is one ranking and one lookup.

Above ``GRID`` tokens of capacity the DP reads lengths in steps of capacity / GRID, rounded up.

Defined results: items of no size are in no bin; a null or non-positive capacity packs nothing; equal
lengths are ranked by a seeded hash of their ids; repeated rows are items each; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from griyaflow.runtime import stored

RANGES = 64
MOST_PROFILES = 1000
#: Relative gap between the bounds of the LP at which it rests; rounds per length (of 50 at least) without a narrower gap after which it does.
GAP = 1e-4
PATIENCE = 2
#: Share of its scarcest length's count that a configuration covers in a round, and how fast prices fall with coverage.
STEP = 0.5
LEARN = 0.5
GRID = 8192


def best_configuration(capacity: int, lens: np.ndarray, price: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Bounded knapsack by dynamic programming: the counts per length, at most ``most``, of the highest price."""
    parts: list[tuple[int, int]] = []  # (index, copies): copies in powers of two
    for i, m in enumerate(np.minimum(most, capacity // lens)):
        k, m = 1, int(m)
        while m > 0:
            parts.append((i, min(k, m)))
            m -= k
            k *= 2
    value = np.zeros(capacity + 1)
    taken = np.zeros((len(parts), capacity + 1), bool)
    for j, (i, k) in enumerate(parts):
        size = k * int(lens[i])
        through = value[:-size] + k * price[i]
        np.greater(through, value[size:] + 1e-12, out=taken[j, size:])
        np.maximum(value[size:], through, out=value[size:])
    counts, c = np.zeros(len(lens), np.int64), capacity
    for j in range(len(parts) - 1, -1, -1):
        if taken[j, c]:
            i, k = parts[j]
            counts[i] += k
            c -= k * int(lens[i])
    return counts


def best_fit(capacity: int, lens: np.ndarray, counts: np.ndarray) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Best-fit decreasing on a histogram: [(((length, times), ...), bins)]."""
    open_: dict[int, list[tuple[tuple, int]]] = {}
    closed = np.zeros(capacity + 1, bool)

    def put(space: int, what: tuple, bins: int) -> None:
        if bins:
            open_.setdefault(space, []).append((what, bins))
            closed[space] = True

    for i in np.argsort(-lens):
        length, n = int(lens[i]), int(counts[i])
        while n:
            at = length + int(closed[length:].argmax())
            if not closed[at]:
                q = capacity // length
                put(capacity - q * length, ((length, q),), n // q)
                if n % q:
                    put(capacity - n % q * length, ((length, n % q),), 1)
                break
            what, bins = open_[at].pop()
            closed[at] = bool(open_[at])
            q = at // length
            whole = min(bins, n // q)
            put(at - q * length, (*what, (length, q)), whole)
            n -= whole * q
            rest = bins - whole
            if rest and n:
                put(at - n * length, (*what, (length, n)), 1)
                n, rest = 0, rest - 1
            put(at, what, rest)
    return [x for groups in open_.values() for x in groups]


def level_prices(capacity: int, lens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Of the prices that no configuration exceeds one bin with, by threshold t, those of the highest bound: nothing below t, a
    whole bin above capacity - t, and the share of the bin, or a whole one for more than half where the small do not fill it, between."""
    best, prices = 0.0, lens / capacity
    for t in [0, *lens[2 * lens <= capacity].tolist()]:
        for middle in (lens / capacity, np.where(2 * lens > capacity, 1.0, np.where(2 * lens == capacity, 0.5, 0.0))):
            price = np.where(lens > capacity - t, 1.0, np.where(lens < t, 0.0, middle))
            if counts @ price > best + 1e-9:
                best, prices = float(counts @ price), price
    return prices


class Lp:
    """The configuration LP of one histogram: ``columns`` (configuration, fractional bins) with its bounds."""

    def __init__(self, capacity: int, lens: np.ndarray, counts: np.ndarray):
        self.first = [(what, float(x)) for what, x in best_fit(capacity, lens, counts)]
        self.columns, self.upper = self.first, sum(x for _, x in self.first)
        level = level_prices(capacity, lens, counts)
        self.lower, self.rounds = float(counts @ level), 0
        grid = -(-capacity // GRID)
        space = capacity // grid
        steps = np.minimum(-(-lens // grid), space)
        covered, bins, total = np.zeros(len(lens)), {}, 0.0
        stale = 0
        fewest = sum(x for _, x in self.first)
        while self.upper - self.lower > GAP * self.lower and np.ceil(self.lower - 1e-6) < fewest and stale <= PATIENCE * max(50, len(lens)):
            price = np.maximum(level, 1e-3 * lens / capacity) * np.exp(-LEARN * (covered - covered.min()))
            config = best_configuration(space, steps, price, np.minimum(counts, space // steps))
            used = np.flatnonzero(config)
            gap = self.upper - self.lower
            if grid == 1:  # else the DP's best may be less than the best of all
                self.lower = max(self.lower, float(counts @ price) / float(config @ price))
            x = STEP * float((counts[used] / config[used]).min())
            covered[used] += config[used] * x / counts[used]
            what = tuple((int(lens[i]), int(config[i])) for i in used)
            bins[what] = bins.get(what, 0.0) + x
            total += x
            if covered.min() > 0 and total / covered.min() < self.upper:
                self.upper = total / covered.min()
                self.columns = [(w, b / covered.min()) for w, b in bins.items()]
            self.rounds += 1
            stale = 0 if self.upper - self.lower < gap - 1e-3 * GAP * self.lower else stale + 1


def rounded(capacity: int, lens: np.ndarray, counts: np.ndarray, lp: Lp) -> tuple[list[tuple[tuple[tuple[int, int], ...], int]], int]:
    """Whole bins [(configuration, bins)] for all items, and how many items the LP's columns place."""
    if lp.columns is lp.first:
        return [(what, int(x)) for what, x in lp.first], int(counts.sum())
    left, made, placed = {int(n): int(k) for n, k in zip(lens, counts, strict=True)}, [], 0

    def take(what: tuple[tuple[int, int], ...], most: int) -> None:
        nonlocal placed
        x = min([most, *(left[n] // k for n, k in what)])
        if x:
            made.append((what, x))
            for n, k in what:
                left[n] -= k * x
                placed += k * x

    for what, x in lp.columns:
        take(what, int(x + 1e-9))
    for what, x in sorted(lp.columns, key=lambda c: (-(c[1] % 1), c[0])):
        take(what, 1)
    made += best_fit(capacity, lens, np.array([left[int(n)] for n in lens]))
    if sum(x for _, x in made) >= sum(x for _, x in lp.first):
        return [(what, int(x)) for what, x in lp.first], int(counts.sum())
    return made, placed


def pack_histogram(capacity: int, lens: np.ndarray, counts: np.ndarray) -> tuple[pd.DataFrame, Lp, int]:
    """Runs (len, first_rank, n, first_bin, per_bin) that give every item its bin, the LP and the items that its columns place."""
    lp = Lp(capacity, lens, counts)
    made, placed = rounded(capacity, lens, counts, lp)
    rank, first, rows = {int(n): 0 for n in lens}, 0, []
    for what, x in made:
        for n, k in what:
            rows.append((n, rank[n], k * x, first, k))
            rank[n] += k * x
        first += x
    return pd.DataFrame(rows, columns=["len", "first_rank", "n", "first_bin", "per_bin"]), lp, placed


def chunks(docs: DataFrame, profiles: DataFrame) -> DataFrame:
    """(profile_id, capacity, doc_id, chunk_no, first_token, len): full chunks and rests. docs: (doc_id, tokens)."""
    # profiles are a parameter table of a few lines: every document meets them as literals, without a join
    lines = profiles.select("profile_id", "capacity_tokens").filter("capacity_tokens > 0").limit(MOST_PROFILES + 1).collect()
    if len(lines) > MOST_PROFILES:
        raise ValueError(f"more than {MOST_PROFILES} profiles")
    each = [F.struct(F.lit(r["profile_id"]).cast("int").alias("profile_id"), F.lit(r["capacity_tokens"]).cast("long").alias("capacity")) for r in lines]
    use = F.explode(F.array(*each).cast("array<struct<profile_id:int,capacity:bigint>>"))
    pairs = docs.filter("tokens > 0").select("doc_id", "tokens", use.alias("u")).select("u.profile_id", "u.capacity", "doc_id", "tokens")
    n = F.ceil(F.col("tokens") / F.col("capacity"))
    cut = pairs.withColumn("chunk_no", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    first = F.col("chunk_no") * F.col("capacity")
    return cut.select("profile_id", "capacity", "doc_id", "chunk_no", first.alias("first_token"), F.least("capacity", F.col("tokens") - first).alias("len"))


def _solve(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    h = pdf.groupby("len", as_index=False)["n"].sum()
    runs, lp, placed = pack_histogram(int(pdf["capacity"].iloc[0]), h["len"].to_numpy(np.int64), h["n"].to_numpy(np.int64))
    return runs.assign(profile_id=key[0], bound=lp.lower, lp_bins=lp.upper, rounds=lp.rounds, by_columns=placed)


def pack(docs: DataFrame, profiles: DataFrame, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(profile_id, bin_id, doc_id, chunk_no, first_token, n_tokens) and the runs with the LP's lower bound."""
    items = stored(chunks(docs, profiles).withColumn("o", F.xxhash64("doc_id", "chunk_no", F.lit(seed).cast("long"))).withColumn("r", F.pmod("o", F.lit(RANGES)).cast("int")), "chunks")
    counts = stored(items.groupBy("profile_id", "capacity", "len", "r").agg(F.count("*").alias("n")), "histogram")
    # a task per profile: few bytes are much work here, so the partitions are not to be coalesced by size
    runs = counts.repartition(min(MOST_PROFILES, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "profile_id").groupBy("profile_id").applyInPandas(_solve, "profile_id int, len long, first_rank long, n long, first_bin long, per_bin long, bound double, lp_bins double, rounds int, by_columns long")
    runs = stored(runs, "runs")
    before = counts.select("profile_id", "len", "r", (F.sum("n").over(Window.partitionBy("profile_id", "len").orderBy("r")) - F.col("n")).alias("before"))
    # rank within (profile, length): ranges of the hash first, so that a length of a third of all items is many tasks
    ranked = items.join(before, ["profile_id", "len", "r"]).withColumn("rank", F.col("before") + F.row_number().over(Window.partitionBy("profile_id", "len", "r").orderBy("o", "doc_id", "chunk_no")) - 1)
    # configurations times their lengths: bounded by the rounds and the capacities, whatever the items
    table = runs.select("profile_id", "len", "first_rank", "first_bin", "per_bin").toPandas().sort_values(["profile_id", "len", "first_rank"])
    lookup = {k: (g["first_rank"].to_numpy(), g["first_bin"].to_numpy(), g["per_bin"].to_numpy()) for k, g in table.groupby(["profile_id", "len"])}

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = np.zeros(len(pdf), np.int64)
            rank = pdf["rank"].to_numpy()
            for k, at in pdf.groupby(["profile_id", "len"]).indices.items():
                starts, bins, per = lookup[k]
                run = np.searchsorted(starts, rank[at], side="right") - 1
                out[at] = bins[run] + (rank[at] - starts[run]) // per[run]
            yield pdf.assign(bin_id=out, n_tokens=pdf["len"])[["profile_id", "bin_id", "doc_id", "chunk_no", "first_token", "n_tokens"]]

    id_type = docs.schema["doc_id"].dataType.simpleString()
    placed = ranked.select("profile_id", "len", "rank", "doc_id", "chunk_no", "first_token").mapInPandas(place, f"profile_id int, bin_id long, doc_id {id_type}, chunk_no long, first_token long, n_tokens long")
    return placed, runs


def pack_report(placed: DataFrame, runs: DataFrame, profiles: DataFrame) -> DataFrame:
    """Per profile: bins, fill, the LP's bounds of bins, its rounds and the chunks that its columns place."""
    per_bin = placed.groupBy("profile_id", "bin_id").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n"))
    used = per_bin.groupBy("profile_id").agg(F.count("*").alias("n_bins"), F.sum("n").alias("n_chunks"), F.sum("t").alias("n_tokens"), F.max("t").alias("fullest"))
    bound = runs.groupBy("profile_id").agg(F.ceil(F.max("bound") - 1e-6).alias("least_bins"), F.max("lp_bins").alias("lp_bins"), F.max("rounds").alias("lp_rounds"), F.max("by_columns").alias("chunks_by_columns"))
    out = profiles.select("profile_id", "profile_name", "capacity_tokens").join(used, "profile_id").join(bound, "profile_id")
    return out.select("profile_id", "profile_name", "capacity_tokens", "n_chunks", "n_tokens", "n_bins", "least_bins", "lp_bins", "lp_rounds", "chunks_by_columns", "fullest", (F.col("n_tokens") / (F.col("n_bins") * F.col("capacity_tokens"))).alias("fill"))
