import numpy as np
import pytest
from pyspark.sql import functions as F

from griyaflow.llm import mixing, packing
from griyaflow.llm.tokens import token_count
from tests.houses import clashing


def packed(spark, sizes, capacities):
    docs = clashing(spark.createDataFrame(list(enumerate(sizes)), "doc_id long, tokens long"), "len", "capacity", "rank", "o", "r")
    profiles = clashing(spark.createDataFrame([(i, f"p{i}", c) for i, c in enumerate(capacities)], "profile_id int, profile_name string, capacity_tokens int"), "n_bins", "capacity")
    placed, runs = packing.pack(docs, profiles)
    return placed, runs, profiles


def test_every_token_once_and_no_bin_over(spark):
    rng = np.random.default_rng(0)
    sizes = [int(x) for x in rng.integers(0, 90, 400)] + [40] * 200 + [1000, 64, 128, None]
    placed, runs, profiles = packed(spark, sizes, [64, 100, None, 0])
    rows = placed.collect()
    for p, cap in ((0, 64), (1, 100)):
        own = [r for r in rows if r["profile_id"] == p]
        bins, docs = {}, {}
        for r in own:
            bins[r["bin_id"]] = bins.get(r["bin_id"], 0) + r["n_tokens"]
            docs.setdefault(r["doc_id"], []).append((r["first_token"], r["n_tokens"]))
        assert max(bins.values()) <= cap
        for i, n in enumerate(sizes):
            parts = sorted(docs.get(i, []))
            assert sum(k for _, k in parts) == (n or 0) and len(parts) == -(-(n or 0) // cap)
            assert all(a + k == b for (a, k), (b, _) in zip(parts, parts[1:]))
    report = {r["profile_id"]: r for r in packing.pack_report(placed, runs, profiles).collect()}
    assert set(report) == {0, 1} and all(r["n_bins"] >= r["least_bins"] for r in report.values()) and report[1]["fill"] > 0.9


def test_no_more_bins_than_best_fit():
    rng = np.random.default_rng(4)
    for cap in (50, 128, 300):
        lens, counts = np.unique(rng.integers(1, cap + 1, 500), return_counts=True)
        runs, lp, placed = packing.pack_histogram(cap, lens, counts)
        bins = bins_of(runs)
        assert lp.lower - 1e-6 <= bins <= sum(x for _, x in packing.best_fit(cap, lens, counts)) and placed >= 0.9 * counts.sum()


def bins_of(runs):
    return int((runs.first_bin + -(-runs.n // runs.per_bin)).max())


def test_lp_beats_best_fit_and_bounds_more_than_the_tokens():
    """Halves, quarters and a bit: best-fit decreasing wastes a bin in eleven, the LP's columns fill every bin."""
    lens, counts = np.array([23, 26, 27, 51]), np.array([120, 60, 60, 60])
    runs, lp, placed = packing.pack_histogram(100, lens, counts)
    assert sum(x for _, x in packing.best_fit(100, lens, counts)) == 110 and bins_of(runs) == 90 and lp.rounds > 0 and placed >= 0.9 * counts.sum()
    got = {}
    for r in runs.itertuples():
        got[r.len] = got.get(r.len, 0) + r.n
    assert got == dict(zip(lens.tolist(), counts.tolist()))
    runs, lp, _ = packing.pack_histogram(100, np.array([35, 60]), np.array([200, 100]))  # tokens would fit 130 bins
    assert 149 < lp.lower <= 150 == bins_of(runs)
    runs, lp, _ = packing.pack_histogram(100, np.array([40]), np.array([100]))
    assert lp.lower == 50 == bins_of(runs)


def test_empty(spark):
    assert packed(spark, [], [64])[0].count() == 0 and packed(spark, [0, None], [64])[0].count() == 0


def test_best_configuration_is_optimal():
    rng = np.random.default_rng(1)
    for _ in range(20):
        lens, most = np.unique(rng.integers(1, 12, 4)), None
        most = rng.integers(1, 4, len(lens))
        price = rng.random(len(lens))
        best = max(sum(price[i] * c for i, c in enumerate(combo)) for combo in np.ndindex(*(most + 1)) if sum(lens[i] * c for i, c in enumerate(combo)) <= 20)
        got = packing.best_configuration(20, lens, price, most)
        assert (got <= most).all() and (got * lens).sum() <= 20 and abs((got * price).sum() - best) < 1e-9


def test_perfect_thirds():
    runs, lp, _ = packing.pack_histogram(100, np.array([20, 30, 50]), np.array([300, 300, 300]))
    assert lp.lower == 300 and bins_of(runs) <= 303


def mixed(spark, docs, plan):
    d = clashing(spark.createDataFrame(docs, "doc_id long, source string, tokens long"), "share", "copies", "r", "o")
    p = clashing(spark.createDataFrame(plan, "mix_id int, source string, target_share double, max_repeats int, total_tokens long"), "source_tokens", "span")
    m, lines = mixing.mix(d.withColumn("source", mixing.source_name(F.col("source"))), p)
    return m.collect(), {(r["mix_id"], r["source"]): r for r in mixing.mix_report(m, lines).collect()}


def test_shares_repeats_and_shortage(spark):
    docs = [(i, (" A", "b ", "c")[i % 3 if i % 3 != 2 or i < 30 else 0], 10) for i in range(900)] + [(5000, None, 10), (5001, " ", 10), (5002, "a", 0), (5003, "a", None)]
    plan = [(1, "a", 0.5, 1, 1000), (1, "b", 0.3, 1, 1000), (1, "c", 0.2, 3, 1000), (2, "c", 0.5, 2, 1000), (2, "b", 0.5, 1, 1000), (3, "x", 1.0, 4, 100), (3, None, 1.0, 4, 100)]
    rows, report = mixed(spark, docs, plan)
    assert [report[1, s]["mixed_tokens"] for s in "abc"] == [500, 300, 200] and report[1, "c"]["repeats"] == 2
    assert report[2, "c"]["mixed_tokens"] == 200 and report[2, "c"]["short"] and report[2, "b"]["mixed_tokens"] == 800 and not report[2, "b"]["short"]
    assert report[3, "x"]["mixed_tokens"] == 0 and report[3, "x"]["short"]
    assert len({(r["mix_id"], r["doc_id"], r["copy"]) for r in rows}) == len(rows)


def test_order_is_by_virtual_time_and_the_longest_prefix_fits(spark):
    rng = np.random.default_rng(2)
    docs = [(i, "ab"[i % 2], int(rng.integers(1, 50))) for i in range(400)] + [(1000, "a", 5000)]
    rows, _ = mixed(spark, docs, [(1, "a", 0.7, 2, 4000), (1, "b", 0.3, 5, 4000)])
    assert sum(r["tokens"] for r in rows) <= 4000
    for s, w in (("a", 0.7), ("b", 0.3)):
        own = sorted((r["finish"], r["tokens"]) for r in rows if r["source"] == s)
        assert np.allclose([f for f, _ in own], np.cumsum([t for _, t in own]) / w)


def test_mix_of_nothing(spark):
    assert mixed(spark, [], [(1, "a", 1.0, 1, 100)])[0] == [] and mixed(spark, [(1, "a", 3)], [])[0] == []


def test_fill_time():
    assert mixing.fill_time([(0.5, 100), (0.5, 1000)], 400) == 600 and mixing.fill_time([(1.0, 10)], 20) == float("inf") and mixing.fill_time([], 5) == float("inf")


def test_tokens(spark):
    df = spark.createDataFrame([("Rumah no. 5a\t—x😀\r\n",), ("",), (None,), ("ab " * 300_000,)], "t string")
    assert [r[0] for r in df.select(token_count(F.col("t"))).collect()] == [7, 0, 0, 300_000]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"])
def test_public_tokenizers(spark, name):
    tokenizers = pytest.importorskip("public_tokenizers")
    df = spark.createDataFrame([("rumah kayu <|endoftext|>",), (None,), ("",)], "t string")
    got = [r[0] for r in df.select(token_count(F.col("t"), tokenizers.path(name))).collect()]
    assert got[0] >= 4 and got[1:] == [0, 0]
