import numpy as np
from pyspark.sql import functions as F

from griyaflow.functions.keys import choice, house_key, path_set
from griyaflow.operators import iblt
from tests.houses import clashing, image, row, table


def test_hash_is_sparks(spark):
    rows = [(0, 0), (1, -1), (2**62, -(2**63)), (-7, 12345)]
    df = spark.createDataFrame(rows, "a long, b long").select("a", "b", F.xxhash64("a", "b").alias("h"), F.xxhash64("a", "b", F.lit(2).cast("long")).alias("h2")).collect()
    a, b = np.array([r["a"] for r in df]), np.array([r["b"] for r in df])
    assert iblt.xxhash64_longs(a, b).tolist() == [r["h"] for r in df]
    assert iblt.xxhash64_longs(a, b, np.full(len(a), 2)).tolist() == [r["h2"] for r in df]


def report(spark, main, mirror, **kw):
    def side(rows, id_col):
        df = clashing(table(spark, rows, id_col), "k", "v", "kh", "rh", "bucket")
        fields = {"kel": F.coalesce(choice(F.col("kelayakan_rumah")), F.lit("")), "paths": path_set(F.col("images"))}
        return iblt.latest_rows(df, house_key(F.col("house_id")), [F.col("captured_at"), F.col(id_col)], fields)

    diff = iblt.field_differences(side(main, "rec_id"), side(mirror, "mirror_id"), ["kel", "paths"], **kw)
    return sorted((r["house_id"], r["field_name"], r["kind"]) for r in iblt.difference_report(diff, "house_id", {"kel": "kelayakan_rumah", "paths": "image_path"}).collect())


def test_rules(spark):
    img = lambda *p: [image(image_path=x) for x in p]
    main = [
        row(1, " h1 ", "Tidak  Layak", images=img("A\\b", None, "c")), row(2, "H2", "layak", images=None), row(3, "H3", None), row(4, "H4", "layak", day=5), row(5, "H4", "tidak_layak", day=1),
        row(6, "H5", "layak"), row(7, " "), row(8, None), row(9, "H7", "layak", day=None), row(10, "H7", "x", day=0), row(11, "H8", "a"), row(12, "H8", "b"),
    ]
    mirror = [
        row(1, "H1", "tidak-layak", images=img("a/B ", "c", "c")), row(2, "H2", "layak", images=[]), row(3, "H3", " "), row(4, "h4", "layak", day=2), row(5, "H5", "tidak_layak", images=img("q")),
        row(6, "H6", "layak"), row(7, "H7", "x", day=0), row(8, "H8", "b"), row(8, "H8", "b"),
    ]
    expected = [("H5", "image_path", "differs"), ("H5", "kelayakan_rumah", "differs"), ("H6", "house_id", "missing_in_main")]
    assert report(spark, main, mirror) == expected
    assert report(spark, main, mirror, start_cells=3) == expected  # built again until it peels


def test_empty_sides(spark):
    assert report(spark, [], []) == []
    assert report(spark, [row(1, "A")], []) == [("A", "house_id", "missing_in_mirror")]


def test_many_differences_against_brute_force(spark):
    rng = np.random.default_rng(1)
    main = [row(i, f"H{i}", str(rng.integers(3))) for i in range(400) if rng.random() < 0.8]
    mirror = [row(i, f"H{i}", str(rng.integers(3))) for i in range(400) if rng.random() < 0.8]
    a, b = ({r[1]: r[2] for r in rows} for rows in (main, mirror))
    want = [(k, "house_id", "missing_in_mirror") for k in a if k not in b] + [(k, "house_id", "missing_in_main") for k in b if k not in a] + [(k, "kelayakan_rumah", "differs") for k in a if k in b and a[k] != b[k]]
    assert report(spark, main, mirror, start_cells=48) == sorted(want)


def test_peel_tells_when_it_is_stuck():
    k = np.arange(100)
    cells = 30
    at = np.concatenate([np.mod(iblt.xxhash64_longs(k, k, np.full(100, j)), 10) + 10 * j for j in range(3)])
    chk = iblt.xxhash64_longs(k, k)
    assert not iblt.peel(at, np.ones(300, int), np.tile(k, 3), np.tile(k, 3), np.tile(chk, 3), cells)[3]


def test_nulls_are_no_other_fields_values(spark):
    left = spark.createDataFrame([("a", "x", None), ("b", None, None), ("c", "", "y")], "k string, f string, g string")
    right = spark.createDataFrame([("a", None, "x"), ("b", None, None), ("c", "y", "")], "k string, f string, g string")
    assert sorted(r["k"] for r in iblt.field_differences(left, right, ["f", "g"]).collect()) == ["a", "c"]


def test_rows_repeated_on_one_side_end(spark):
    left = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y")], "k string, f string")
    right = spark.createDataFrame([("b", "y")], "k string, f string")
    assert {r["k"] for r in iblt.field_differences(left, right, ["f"], 12).collect()} == {"a"}
