import numpy as np

from griyaflow.llm import balanced
from griyaflow.llm.balanced import Aim, Flight, pivotal
from griyaflow.llm.sample_queries import p1_found, p1_report, p1_sample
from tests.houses import clashing, image, row, table


def test_flight_keeps_counts_and_ends_with_few_fractions():
    rng = np.random.default_rng(0)
    x = np.vstack([np.ones(300), rng.random((6, 300)) < 0.3]).astype(float)
    p = rng.random(300)
    before = x @ p
    Flight(7, rng).run(x, p)
    assert np.allclose(x @ p, before, atol=1e-6) and ((p > 0) & (p < 1)).sum() <= 7 and (p >= 0).all() and (p <= 1).all()


def test_flight_is_unbiased():
    rng = np.random.default_rng(1)
    x = np.array([[1.0, 1, 1, 1], [1, 0, 1, 0]])
    start = np.array([0.2, 0.5, 0.6, 0.7])
    mean = np.mean([Flight(2, rng).run(x, start.copy()) for _ in range(4000)], axis=0)
    assert np.allclose(mean, start, atol=0.04)


def test_pivotal():
    rng = np.random.default_rng(2)
    runs = np.array([pivotal(np.array([0.3, 0.9, 0.5, 0.8]), rng) for _ in range(4000)])
    assert np.allclose(runs.mean(0), [0.3, 0.9, 0.5, 0.8], atol=0.04) and np.allclose(runs.sum(1), 2.5)
    assert (((runs > 0) & (runs < 1)).sum(1) <= 1).all()


def plan_tables(spark, tmp_path, rows, plan):
    clashing(table(spark, rows), "unit", "m0", "o", "p", "cat").write.parquet(f"{tmp_path}/sample_15.parquet")
    clashing(spark.createDataFrame(plan, "plan_id int, component string, category string, target_share double, min_count int, sample_size int"), "pool", "cat", "drawn").write.parquet(f"{tmp_path}/sample_plan.parquet")
    return str(tmp_path)


def test_shares_minimum_and_shortage(spark, tmp_path):
    rng = np.random.default_rng(3)
    mats = ["a", "b", "c"]
    rows = [row(i, f"h{i}", ("layak", "Tidak-Layak")[int(rng.random() < 0.3)], images=[image(material_atap=f" {mats[min(2, int(rng.exponential(0.7)))].upper()} "), None]) for i in range(3000)]
    rows += [row(9001, "rare", "layak", images=[image(material_atap="z")]), row(9002, "RARE ", None), row(9003, None, "layak", images=[image(material_atap="z")]), row(9004, " ", "layak")]
    plan = [(1, "atap", "a", 0.2, 0, 200), (1, "atap", "b", 0.5, 0, 200), (1, "atap", "c", 0.3, 0, 200), (1, "atap", "z", 0.0, 1, 200), (1, "kelayakan_rumah", "layak", 0.4, 0, 200), (1, "kelayakan_rumah", "tidak_layak", 0.6, 0, 200), (2, "atap", "z", 0.9, 2, 10), (2, "atap", "none", 0.1, 1, 10)]
    d = plan_tables(spark, tmp_path, rows, plan)
    report = {(r["plan_id"], r["category"]): r for r in p1_report(spark, d).collect()}
    for c in ("a", "b", "c", "layak", "tidak_layak"):
        assert report[1, c]["status"] == "met", report[1, c]
    assert report[1, "z"]["drawn"] == 1 and report[1, "z"]["pool"] == 1
    assert sorted((r["plan_id"], r["category"]) for r in p1_found(spark, d).collect()) == [(2, "none"), (2, "z")]
    drawn = [r for r in p1_sample(spark, d).collect() if r["plan_id"] == 1]
    assert len({r["house_id"] for r in drawn}) == len(drawn) == 200


def test_conflicts_are_told_and_samples_are_repeatable(spark, tmp_path):
    """Half of the houses show no roof, so a size of 600 can't hold 600 roofs; the counts in the report are those of the sample."""
    rng = np.random.default_rng(5)
    rows = [row(i, f"h{i}", "layak" if rng.random() < 0.5 else "tidak layak", images=[image(material_atap="ab"[int(rng.random() < 0.5)])] if rng.random() < 0.5 else None) for i in range(1000)]
    plan = [(1, "atap", "a", 0.5, 0, 600), (1, "atap", "b", 0.5, 0, 600), (1, "kelayakan_rumah", "layak", 0.3, 0, 600), (2, "atap", "a", 0.2, 0, 100), (2, "atap", "b", 0.3, 0, 100), (2, "kelayakan_rumah", "layak", 0.8, 0, 100)]
    d = plan_tables(spark, tmp_path, rows, plan)
    samples = []
    for n in ("4", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        samples.append(sorted((r["plan_id"], r["house_id"]) for r in p1_sample(spark, d).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert samples[0] == samples[1] and [sum(k == p for k, _ in samples[0]) for p in (1, 2)] == [600, 100]
    roof = {r["house_id"].upper(): {i["material_atap"] for i in r["images"] or []} for r in spark.read.parquet(f"{d}/sample_15.parquet").collect()}
    report = {(r["plan_id"], r["category"]): r for r in p1_report(spark, d).collect()}
    for k, c in ((1, "a"), (1, "b"), (2, "a"), (2, "b")):
        n, r = sum(c in roof[h] for p, h in samples[0] if p == k), report[k, c]
        assert r["drawn"] == n and r["share"] == n / r["sample_size"] and (r["status"] == "met") == (abs(n - r["asked"]) <= max(1, 0.05 * r["asked"])) and r["calibrated"]
    assert report[1, "a"]["status"] in ("below_target", "pool_too_small") and report[2, "b"]["status"] == "met" and report[2, "layak"]["status"] == "met"


def test_empty(spark, tmp_path):
    d = plan_tables(spark, tmp_path, [], [(1, "atap", "a", 0.5, 1, 10)])
    assert [tuple(r) for r in p1_found(spark, d).collect()] == [(1, "atap", "a")] and p1_sample(spark, d).count() == 0
    none = plan_tables(spark, tmp_path / "x", [row(1, "A")], [])
    assert p1_found(spark, none).count() == 0 and p1_sample(spark, none).count() == 0


def test_more_categories_than_a_word(spark):
    code = {f"c{i}": i for i in range(130)}
    assert balanced._words(130) == 3 and len(balanced.bits_of(spark.range(1)["id"].cast("string"), code, 3)) == 3
    aim = Aim(10, [(i, 1 / 13, 0, False) for i in range(130)], 130)
    assert aim.target.shape == aim.ridge.shape == (131,)
