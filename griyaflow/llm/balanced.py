"""Samples matching target category proportions, by the cube method.

Every unit (house) is a set of categories, kept as bit masks. Inclusion probabilities come first: a
logistic calibration finds one factor per category so that the expected sample has the asked size and
each category its asked count, the greater of minimum and share x size, or its whole pool where that is
smaller. Counts that exclude one another end in a compromise in proportion to what was asked; sizes,
minimum counts and small pools are held hard. Only sums over all units, one per category pair, in PARTIAL
parts at most, reach the driver. The probabilities are then rounded to a sample by flight phases of the cube method, which move along
directions that leave every category's count unchanged until units are in or out:

1. per partition: units with the same mask are interchangeable, so directions exchange probability
   between two of them until at most one per mask is unresolved;
2. the unresolved of all partitions are met again per mask, then in groups of masks, in the null space
   of the category indicators, level by level, until few are left per plan;
3. landing drops the balancing of one category after the other until nothing is fractional.

A repair adds units, in a random order, to categories that ended below a minimum they could have met, and
brings the sample back to its size with units that no minimum needs. Partitions of the flights are slots of
the units' hashes, one per ``PER_SLOT`` units, and random numbers are seeded by plan and slot: the sample
depends on the data and the seed alone, not on the cluster.

Defined results: null or blank keys are no unit; a unit without any category can be drawn to fill the
size; plan lines with null category, share or counts are read as 0 or empty; lines whose pool is too
small are reported, all their pool is aimed at; an empty pool or plan gives an empty sample; repeated
rows of a unit are one unit with all their categories.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from griyaflow.runtime import stored

WORD = 62
#: How far a count may give way, against its asked number and the strain (log-odds) on it; minimum counts and pools that are too small give way less.
SOFT, HARD = 0.01, 0.001
#: Expected counts are calibrated to so many units; Newton's method stops at so many rounds, which the report then says.
CLOSE, ROUNDS = 0.3, 300
GROUP = 1500
#: Units per slot of the first flight.
PER_SLOT = 1 << 16
#: Tasks of a calibration round, so partial sums of a plan that reach the driver, at most.
PARTIAL = 32
#: Units looked at for each that a sample has too many.
SPARE = 64
#: A line is met if the drawn units differ from the asked by this share of them, or by one unit, at most.
TOLERANCE = 0.05


class Flight:
    """Moves fractional units along the null space of their indicators, in a reduced basis of at most one unit per row."""

    def __init__(self, n_rows: int, rng: np.random.Generator):
        self.rows, self.rng = n_rows, rng

    def run(self, a: np.ndarray, p: np.ndarray, rows: int | None = None) -> np.ndarray:
        """``a``: rows x units, ``p``: probabilities, changed in place. ``rows``: only the first so many are kept balanced."""
        d = self.rows if rows is None else rows
        ops, basic = np.eye(d), np.full(d, -1)
        for q in range(a.shape[1]):
            if p[q] <= 0 or p[q] >= 1:
                continue
            v = ops @ a[:d, q]
            free = np.flatnonzero((basic < 0) & (np.abs(v) > 1e-9))
            while not len(free):
                held = np.flatnonzero(basic >= 0)
                u = np.zeros(d)
                u[held] = -v[held]
                x = p[basic[held]]
                up, down = u[held] > 1e-12, u[held] < -1e-12
                with np.errstate(divide="ignore", invalid="ignore"):
                    fwd = np.min(np.r_[1 - p[q], np.where(up, (1 - x) / u[held], np.inf), np.where(down, -x / u[held], np.inf)])
                    back = np.min(np.r_[p[q], np.where(up, x / u[held], np.inf), np.where(down, (x - 1) / u[held], np.inf)])
                step = fwd if self.rng.random() * (fwd + back) < back else -back
                p[q] += step
                p[basic[held]] += step * u[held]
                near = np.r_[basic[held], q]
                vals = p[near]
                vals[vals < 1e-9] = 0.0
                vals[vals > 1 - 1e-9] = 1.0
                p[near] = vals
                basic[held[(p[basic[held]] == 0) | (p[basic[held]] == 1)]] = -1
                if p[q] in (0.0, 1.0):
                    break
                free = np.flatnonzero((basic < 0) & (np.abs(v) > 1e-9))
            if 0 < p[q] < 1:
                r = free[np.argmax(np.abs(v[free]))]
                ops[r] /= v[r]
                other = np.arange(d) != r
                ops[other] -= np.outer(v[other], ops[r])
                basic[r] = q
        return p


def pivotal(p: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Flight among interchangeable units: exchanges probability until at most one is fractional."""
    at = -1
    for i in np.flatnonzero((p > 0) & (p < 1)):
        if at < 0:
            at = i
            continue
        a, b = p[at], p[i]
        s = a + b
        if s <= 1:
            keep, lose = (at, i) if rng.random() * s < a else (i, at)
            p[lose], p[keep] = 0.0, min(1.0, s)
        else:
            full, keep = (at, i) if rng.random() * (2 - s) < 1 - b else (i, at)
            p[full], p[keep] = 1.0, max(0.0, s - 1)
        at = keep
        if p[at] < 1e-9 or p[at] > 1 - 1e-9:
            p[at] = round(p[at])
            at = -1
    return p


def _indicators(masks: np.ndarray, n_cat: int) -> np.ndarray:
    """Rows: one of ones (the size), then the categories. masks: units x words."""
    out = [np.ones(len(masks))]
    out += [(masks[:, c // WORD] >> (c % WORD) & 1).astype(float) for c in range(n_cat)]
    return np.array(out)


def _seed(*parts: object) -> np.random.Generator:
    return np.random.default_rng([int(x) & 0x7FFFFFFF for x in parts])


def _words(n_cat: int) -> int:
    return max(1, -(-n_cat // WORD))


class Aim:
    """What a plan asks of the calibration: a size and a count per category, with how far each may give way."""

    def __init__(self, size: float, lines: list[tuple[int, float, int, bool]], n_cat: int):
        """``lines``: (category, asked count, least count, pool is too small), counts no greater than the pool."""
        self.least = {c: m for c, _, m, _ in lines}
        self.target, self.ridge, self.used = np.zeros(n_cat + 1), np.full(n_cat + 1, 1.0), np.zeros(n_cat + 1)
        self.target[0], self.ridge[0], self.used[0] = size, 1e-6, 1.0
        for c, asked, _, short in lines:
            self.target[c + 1], self.used[c + 1] = asked, 1.0
            self.ridge[c + 1] = (HARD if short else SOFT) * max(1.0, asked)

    def pin(self, expected: np.ndarray) -> bool:
        """Categories expected below their least count are to reach that count hard."""
        below = [c for c, m in self.least.items() if expected[c + 1] < m - 0.5 and (self.target[c + 1] != m or self.ridge[c + 1] > HARD * max(1.0, m))]
        for c in below:
            self.target[c + 1], self.ridge[c + 1] = self.least[c], HARD * max(1.0, self.least[c])
        return bool(below)


class _Newton:
    """Newton's method with backtracking on the convex dual of one plan's calibration."""

    def __init__(self, aim: Aim):
        self.aim, d = aim, len(aim.target)
        self.lam = np.r_[-6.0, np.zeros(d - 1)]
        self.best: tuple[np.ndarray, float, np.ndarray] | None = None  # last accepted point, its value, the move tried from it
        self.done = False

    def step(self, value: float, grad: np.ndarray, hess: np.ndarray) -> None:
        """Sums over all units at ``lam``: of the log-partition, of the counts, of their covariances."""
        aim = self.aim
        value = value - aim.target @ self.lam + 0.5 * (aim.ridge * self.lam) @ self.lam
        g = (grad + aim.ridge * self.lam - aim.target) * aim.used
        if self.best is not None and value > self.best[1] + 1e-9 * max(1.0, abs(self.best[1])):
            at, was, move = self.best
            if np.abs(move).max() > 1e-6:
                self.best, self.lam = (at, was, move / 2), at - move / 2
                return
        if np.abs(g).max() < CLOSE:
            if not aim.pin(grad):
                self.done = True
                return
            self.best, value = None, np.inf
            g = (grad + aim.ridge * self.lam - aim.target) * aim.used
        move = np.linalg.solve(hess + np.diag(aim.ridge), g)
        move *= min(1.0, 12.0 / max(np.abs(move).max(), 1e-12))
        self.best = None if value == np.inf else (self.lam, value, move)
        self.lam = self.lam - move


def calibrate(cells: DataFrame, n_cat: int, aims: dict[int, Aim], rounds: int = ROUNDS) -> tuple[dict[int, np.ndarray], set[int]]:
    """Factors (size, categories) per plan: probability = logistic(sum of the factors of a unit's categories);
    and the plans that did not come to rest.

    ``cells``: (m0.., n) distinct masks with their units. A round sends, per plan, at most PARTIAL gradients
    and matrices of category pairs."""
    d = n_cat + 1
    state = {k: _Newton(a) for k, a in aims.items()}
    words = [f"m{w}" for w in range(_words(n_cat))]
    for _ in range(rounds):
        now = {k: s.lam for k, s in state.items() if not s.done}
        if not now:
            break

        def part(batches: Iterator[pd.DataFrame], now: dict[int, np.ndarray] = now) -> Iterator[pd.DataFrame]:
            sums = {k: np.zeros(1 + d + d * d) for k in now}
            for pdf in batches:
                x, n = _indicators(pdf[words].to_numpy(np.int64), n_cat), pdf["n"].to_numpy(float)
                for k, f in now.items():
                    at = f @ x
                    p = 1 / (1 + np.exp(-np.clip(at, -40, 40)))
                    sums[k] += np.r_[n @ np.logaddexp(0, at), x @ (n * p), ((x * (n * p * (1 - p))) @ x.T).ravel()]
            yield pd.DataFrame({"k": list(now), "s": [sums[k].tobytes() for k in now]})

        total = {k: np.zeros(1 + d + d * d) for k in now}
        for r in cells.coalesce(PARTIAL).mapInPandas(part, "k int, s binary").collect():
            total[r["k"]] = total[r["k"]] + np.frombuffer(r["s"])
        for k, s in total.items():
            state[k].step(float(s[0]), s[1 : d + 1], s[d + 1 :].reshape(d, d))
    return {k: s.lam for k, s in state.items()}, {k for k, s in state.items() if not s.done}


def _first_flight(n_cat: int, factors: dict[int, np.ndarray], key: str):
    """Level 1, over one slot of units: resolves all but one per mask and plan."""
    words = [f"m{w}" for w in range(_words(n_cat))]

    def run(group: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([*words, "o", key], ignore_index=True)
        masks, ids = pdf[words].to_numpy(np.int64), pdf[key].to_numpy()
        starts = np.flatnonzero(np.r_[True, (masks[1:] != masks[:-1]).any(axis=1)])
        sizes = np.diff(np.r_[starts, len(pdf)])
        x = _indicators(masks[starts], n_cat)
        out = []
        for k, f in factors.items():
            # equal probabilities within a mask: exchanging them all, in random order, ends in floor(sum) units and one fraction
            total = sizes / (1 + np.exp(-np.clip(f @ x, -40, 40)))
            whole = np.floor(total + 1e-9).astype(int)
            rest = np.where(total - whole > 1e-9, total - whole, 0.0)
            at = np.repeat(starts, whole) + np.arange(whole.sum()) - np.repeat(np.cumsum(whole) - whole, whole)
            open_ = np.flatnonzero(rest)
            at, p = np.r_[at, (starts + whole)[open_]], np.r_[np.ones(len(at)), rest[open_]]
            out.append(pd.DataFrame({"plan_id": k, key: ids[at], **{c: masks[at, i] for i, c in enumerate(words)}, "p": p}))
        return pd.concat(out, ignore_index=True)

    return run


def _group_flight(n_cat: int, key: str, seed: int, land: bool):
    """A flight over one group of unresolved units; ``land`` resolves what the flight leaves."""
    words = [f"m{w}" for w in range(_words(n_cat))]

    def run(group: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        rng = _seed(seed, group[0], group[-1])
        pdf = pdf.sort_values([*words, key]).reset_index(drop=True)
        p = pdf["p"].to_numpy(float).copy()
        masks = pdf[words].to_numpy(np.int64)
        starts = np.flatnonzero(np.r_[True, (masks[1:] != masks[:-1]).any(axis=1)])
        for s, e in zip(starts, np.r_[starts[1:], len(p)], strict=True):
            if e - s > 1:
                p[s:e] = pivotal(p[s:e], rng)
        left = np.flatnonzero((p > 0) & (p < 1))
        left = left[rng.permutation(len(left))]
        x = _indicators(masks[left], n_cat)
        q = p[left]
        flight = Flight(n_cat + 1, rng)
        flight.run(x, q)
        if land:
            for d in range(n_cat, -1, -1):
                rest = np.flatnonzero((q > 0) & (q < 1))
                if not len(rest):
                    break
                sub = q[rest]
                flight.run(x[:, rest], sub, d)
                q[rest] = sub
        p[left] = q
        return pdf.assign(p=p)[["plan_id", key, *words, "p"]][p > 0]

    return run


def draw(units: DataFrame, cells: DataFrame, n_units: int, n_cat: int, aims: dict[int, Aim], key: str, seed: int) -> tuple[DataFrame, set[int]]:
    """(plan_id, key, m..) of the drawn units, and the plans whose calibration did not come to rest."""
    words = [f"m{w}" for w in range(_words(n_cat))]
    key_type = units.schema[key].dataType.simpleString()
    ddl = f"plan_id int, {key} {key_type}, {', '.join(f'{w} long' for w in words)}, p double"
    factors, restless = calibrate(cells, n_cat, aims)
    # few bytes are much work here: partitions are asked for by number, else they are coalesced by size
    tasks = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = -(-n_units // PER_SLOT)
    slotted = units.withColumn("o", F.xxhash64(key, F.lit(seed).cast("long"))).withColumn("slot", F.pmod(F.xxhash64("o"), F.lit(slots)).cast("int"))
    level = stored(slotted.repartition(min(slots, tasks), "slot").groupBy("slot").applyInPandas(_first_flight(n_cat, factors, key), ddl), "flight")
    done = [level.filter("p >= 1")]
    open_ = level.filter("p < 1")
    depth = 0
    while True:
        widest = open_.groupBy("plan_id").count().agg(F.max("count")).first()[0] or 0
        slots, depth = max(1, -(-widest // GROUP)), depth + 1
        # equal masks meet in one group: first interchanged, then balanced against the others; a group leaves n_cat + 1 units at most
        slotted = open_.withColumn("slot", F.pmod(F.xxhash64(*words), F.lit(slots)).cast("int")).repartition(min(len(aims) * slots, tasks), "plan_id", "slot")
        level = stored(slotted.groupBy("plan_id", "slot").applyInPandas(_group_flight(n_cat, key, seed + depth, slots == 1), ddl), "flight")
        done.append(level.filter("p >= 1"))
        if slots == 1:
            break
        open_ = level.filter("p < 1")
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out.drop("p"), restless


def category_masks(rows: DataFrame, key: Column, found: list[Column], n_cat: int) -> DataFrame:
    """(unit, m0..): categories of any row of a unit. ``found``: per word a long column with the row's bits."""
    flat = rows.select(key.alias("unit"), *[c.alias(f"m{w}") for w, c in enumerate(found)]).filter("unit is not null")
    return flat.groupBy("unit").agg(*[F.bit_or(f"m{w}").alias(f"m{w}") for w in range(_words(n_cat))])


def bits_of(value: Column, code: dict[str, int], n_words: int) -> list[Column]:
    """Per word the bit of a value's category; 0 for no category."""
    out = []
    for w in range(n_words):
        own = {v: 1 << (c % WORD) for v, c in code.items() if c // WORD == w}
        if not own:
            out.append(F.lit(0).cast("long"))
            continue
        pairs = [F.lit(x) for v, b in own.items() for x in (v, b)]
        out.append(F.coalesce(F.try_element_at(F.create_map(*[p if i % 2 == 0 else p.cast("long") for i, p in enumerate(pairs)]), value), F.lit(0).cast("long")))
    return out


def category_counts(masks: DataFrame, n_cat: int, by: list[str]) -> DataFrame:
    """(by.., cat, n) units per category."""
    if not n_cat:
        return masks.sparkSession.createDataFrame([], ", ".join([*[f"{b} int" for b in by], "cat int", "n long"]))
    sums = [F.sum(F.shiftright(f"m{c // WORD}", c % WORD).bitwiseAND(1)).alias(f"c{c}") for c in range(n_cat)]
    stack = ", ".join(f"{c}, c{c}" for c in range(n_cat))
    return masks.groupBy(*by).agg(*sums).selectExpr(*by, f"stack({n_cat}, {stack}) as (cat, n)")


def sample_to_plan(units: DataFrame, plan: list[dict], cats: list[tuple[str, str]], seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """The drawn (plan_id, unit) and the report, one row per plan line. ``units``: (unit, m0..) over ``cats``."""
    spark, n_cat = units.sparkSession, len(cats)
    units = stored(units, "units")
    code = {c: i for i, c in enumerate(cats)}
    words = [f"m{w}" for w in range(_words(n_cat))]
    pool = {r["cat"]: r["n"] or 0 for r in category_counts(units, n_cat, []).collect()} if n_cat else {}
    n_units = units.count()
    cells = stored(units.groupBy(*words).agg(F.count("*").alias("n")), "cells")
    aims, least, sizes = {}, [], {}
    for k in sorted({r["plan_id"] for r in plan}):
        lines = [r for r in plan if r["plan_id"] == k]
        size = min(max(float(r["sample_size"] or 0) for r in lines), n_units)
        aimed = []
        for r in lines:
            c = code[(r["component"], r["category"])]
            asked, have = max(float(r["min_count"] or 0), float(r["target_share"] or 0) * float(r["sample_size"] or 0)), pool.get(c, 0)
            aimed.append((c, min(asked, have), min(int(r["min_count"] or 0), have), have < asked))
            least.append((k, c, aimed[-1][2]))
        sizes[k] = int(size)
        aims[k] = Aim(min(size, 0.999 * n_units), aimed, n_cat)
    drawn, restless = spark.createDataFrame([], "plan_id int, unit string, " + ", ".join(f"{w} long" for w in words)), set()
    if aims and n_units:
        drawn, restless = draw(units, cells, n_units, n_cat, aims, "unit", seed)
        drawn = repaired(units, stored(drawn, "drawn"), n_cat, least, sizes, seed)
    lines = spark.createDataFrame(
        [(r["plan_id"], r["component"], r["category"], float(r["target_share"] or 0), int(r["min_count"] or 0), int(r["sample_size"] or 0), code[(r["component"], r["category"])], int(pool.get(code[(r["component"], r["category"])], 0)), r["plan_id"] not in restless) for r in plan],
        "plan_id int, component string, category string, target_share double, min_count int, sample_size int, cat int, pool long, calibrated boolean",
    )
    counts = category_counts(drawn, n_cat, ["plan_id"]).withColumnRenamed("n", "drawn")
    drawn_sizes = drawn.groupBy("plan_id").agg(F.count("*").alias("sample_drawn"))
    report = lines.join(counts, ["plan_id", "cat"], "left").join(drawn_sizes, "plan_id", "left").fillna(0, ["drawn", "sample_drawn"])
    asked = F.greatest(F.col("min_count").cast("double"), F.col("target_share") * F.col("sample_size"))
    shown = F.sum("drawn").over(Window.partitionBy("plan_id", "component"))
    ratio = lambda n: F.coalesce(F.try_divide(F.col("drawn"), n), F.lit(0.0))
    report = report.withColumn("asked", asked).withColumn("share", ratio(F.col("sample_drawn"))).withColumn("share_in_component", ratio(shown)).withColumn("residual", F.col("drawn") - F.col("asked"))
    off = F.greatest(F.lit(1.0), F.lit(TOLERANCE) * F.col("asked"))
    status = F.when(F.col("pool") < F.col("asked"), "pool_too_small").when(F.col("drawn") < F.col("min_count"), "below_minimum").when(F.abs("residual") <= off, "met")
    return drawn.select("plan_id", "unit"), report.withColumn("status", status.when(F.col("residual") < 0, "below_target").otherwise("above_target")).drop("cat")


def repaired(units: DataFrame, drawn: DataFrame, n_cat: int, least: list[tuple[int, int, int]], sizes: dict[int, int], seed: int) -> DataFrame:
    """``drawn`` with the units that its minimum counts lack, then brought to its size: surplus units leave that no
    minimum needs, missing ones come in; all in an order of hashes. A surplus without such units stays."""
    spark = units.sparkSession
    order = [F.xxhash64("unit", F.lit(seed).cast("long")), F.col("unit")]
    first = lambda rows, by, col: rows.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("place") <= F.col(col))

    def counts() -> dict[tuple[int, int], int]:
        return {(r["plan_id"], r["cat"]): r["n"] or 0 for r in category_counts(drawn, n_cat, ["plan_id"]).collect()}

    have = counts()
    gaps = [(k, c, n - have.get((k, c), 0)) for k, c, n in least if n > have.get((k, c), 0)]
    if gaps:
        need = spark.createDataFrame(gaps, "plan_id int, cat int, need int")
        bit = F.array(*[F.shiftright(f"m{c // WORD}", c % WORD).bitwiseAND(1) == 1 for c in range(n_cat)])
        lacking = units.withColumn("cat", F.explode(F.filter(F.transform(bit, lambda x, i: F.when(x, i)), lambda i: i.isNotNull()))).join(F.broadcast(need), "cat")
        lacking = lacking.join(drawn.select("plan_id", "unit"), ["plan_id", "unit"], "left_anti").filter(F.col("need") > 0)
        more = first(lacking.withColumn("most", F.lit(max(n for _, _, n in gaps))), ["plan_id", "cat"], "most").filter("place <= need").select(*drawn.columns).distinct()
        drawn = stored(drawn.unionByName(more), "drawn")
        have = counts()
    n = {r["plan_id"]: r["count"] for r in drawn.groupBy("plan_id").count().collect()}
    over, under = {k: n.get(k, 0) - s for k, s in sizes.items() if n.get(k, 0) > s}, {k: s - n.get(k, 0) for k, s in sizes.items() if n.get(k, 0) < s}
    if over:
        # of SPARE units per surplus one, those of the fewest categories first, each leaves if every minimum is still kept
        need = spark.createDataFrame([(k, SPARE * n) for k, n in over.items()], "plan_id int, most int")
        held = sum((F.bit_count(f"m{w}") for w in range(_words(n_cat))), F.lit(0))
        rank = F.row_number().over(Window.partitionBy("plan_id").orderBy(held, *order))
        least_of = {(k, c): m for k, c, m in least}
        go = []
        for r in drawn.join(F.broadcast(need), "plan_id").withColumn("place", rank).filter(f"place <= {SPARE * max(over.values())}").filter("place <= most").orderBy("plan_id", "place").collect():
            k, cats = r["plan_id"], [c for c in range(n_cat) if r[f"m{c // WORD}"] >> (c % WORD) & 1]
            if over[k] and all(have.get((k, c), 0) > least_of.get((k, c), 0) for c in cats):
                over[k] -= 1
                go.append((k, r["unit"]))
                for c in cats:
                    have[k, c] -= 1
        drawn = drawn.join(spark.createDataFrame(go, drawn.select("plan_id", "unit").schema), ["plan_id", "unit"], "left_anti")
    if under:
        need = F.explode(F.array(*[F.struct(F.lit(k).alias("plan_id"), F.lit(m).alias("missing")) for k, m in under.items()]))
        spare = units.withColumn("need", need).select("*", "need.*").join(drawn.select("plan_id", "unit"), ["plan_id", "unit"], "left_anti")
        drawn = drawn.unionByName(first(spare.withColumn("most", F.lit(max(under.values()))), ["plan_id"], "most").filter("place <= missing").select(*drawn.columns))
    return stored(drawn, "drawn")
