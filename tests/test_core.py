import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from griyaflow.functions import text as X
from griyaflow.functions.labels import code_table, label_map
from griyaflow.functions.urls import is_image_url
from griyaflow.operators import chat, dedup, houses, keyed, ranking, reconcile, sampling
from griyaflow.operators.components import least_label
from griyaflow.operators.fold import cap_by_brute_force
from griyaflow.operators.profile import key_uniqueness, missing_combos, pivot_counts
from tests.houses import image, row, table


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("f", "value", "want"),
    [
        (X.normalize_cell, " [ ] ", None), (X.normalize_cell, "\tNaN ", None), (X.normalize_cell, " a ", "a"), (X.clean_card_number, "123.0", "123"), (X.clean_card_number, "none", None),
        (X.digits_code, "1.0", "10"), (X.digits_code, "01", "1"), (X.digits_code, "9x", "9"), (X.digits_code, "0", "0"), (X.digits_code, "x", None),
        (X.spreadsheet_code, "1.0", "1"), (X.spreadsheet_code, "01", "01"), (X.spreadsheet_code, " ", None),
        (lambda c: X.canonical_label(c, label_map("dinding")), " anyaman_BAMBU ", "Anyaman bambu"), (lambda c: X.canonical_label(c, label_map("lantai")), "UNCLASSIFIED", "unclassified"),
        (lambda c: X.canonical_label(c, label_map("lantai")), "marmer", "marmer"),  (lambda c: X.canonical_label(c, label_map("dinding")), "Kayu papan  GYPSUM_grc calciboard", "Kayu/papan/gypsum/GRC/calciboard"), (lambda c: X.label_of_code(c, code_table("dinding")), "2.", "plesteran_anyaman_bambu/kawat"), (lambda c: X.canonical_label(c, label_map("lantai")), " ", ""),
        (X.links_of_cell, "[http://a/1.jpg, 'https://a/2', http://a/?prefix=, ftp://x]", ["http://a/1.jpg", "https://a/2"]), (X.links_of_cell, None, []), (X.links_of_cell, "[]", []),
        (X.url_extension, "http://a/b.c/d", ".jpg"), (X.url_extension, "http://a/d.PNG?x=1.gif", ".PNG"), (X.detected, "TIDAK terdeteksi", "Tidak terdeteksi"),
        (X.anomaly_mode, "anomali-12", "normal"), (X.anomaly_mode, "Anomaly 2", "flip_kept_images"), (X.anomaly_mode, "anomali_1; anomali 2", "swap_slots"), (X.keeps, None, True), (X.keeps, " keep", True), (X.keeps, "DROP", False),
    ],
)
def test_cell_rules(spark, f, value, want):
    assert one(spark, value, f) == want


@pytest.mark.parametrize(
    ("url", "want"),
    [("http://a.b/x.jpg", True), ("http://a.b/x", False), ("http://a.b/x?format=png", True), ("https://www.google.com/x.jpg", False), ("http://i.facebook.com/x.jpg", False), ("http://a.b/", False), ("http://a.b/news/x.jpg", False), ("http://a.b/x.svg", False), (None, False), ("data:image", False)],
)
def test_urls(spark, url, want):
    assert one(spark, url, is_image_url) is want


def test_host_characters(spark):
    assert one(spark, "http://w.web.com/a.jpg", lambda c: is_image_url(c, strip_characters=True)) is True


@pytest.mark.parametrize(("n", "want"), [(1, "1/0/0"), (2, "1/0/1"), (3, "1/1/1"), (4, "2/1/1"), (5, "3/1/1"), (10, "8/1/1"), (13, "11/1/1"), (14, "11/2/1"), (16, "13/2/1"), (17, "13/2/2"), (24, "19/3/2"), (27, "21/3/3"), (35, "28/4/3"), (45, "36/5/4"), (55, "44/6/5"), (100, "80/10/10")])
def test_split_sizes(spark, n, want):
    sizes = spark.createDataFrame([(n,)], "n long").select(*[c.alias(k) for k, c in sampling.desired_split_sizes(F.col("n")).items()]).first()
    assert "/".join(str(sizes[k]) for k in ("train", "val", "test")) == want


def test_split_keeps_units_and_skips_null_strata(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2] if i else None) for i in range(41)], "u long, s string")
    got = sampling.stratified_split(df, "u", "s").groupBy("s", "new_split").count().collect()
    assert {(r["s"], r["new_split"]): r["count"] for r in got} == {(s, k): n for s in "ab" for k, n in (("train", 16), ("val", 2), ("test", 2))}


def test_rank_by_hash_is_a_plain_rank(spark):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else "k") for i in range(500)], "i long, k string").withColumn("o", ranking.hash_order(F.col("i")))
    rows = ranking.rank_by_hash(df, ["k"], "o", ["i"]).collect()
    for k in (None, "k"):
        own = sorted((r["o"], r["i"], r["rank"]) for r in rows if r["k"] == k)
        assert [x[2] for x in own] == list(range(1, len(own) + 1))


def test_global_rank(spark):
    rows = ranking.global_rank(spark.range(1000).select((F.col("id") * 7 % 1000).alias("id")), ["id"]).collect()
    assert all(r["rank"] == r["id"] + 1 for r in rows)


def test_proportional_sample_is_exact(spark):
    df = spark.createDataFrame([(i, "abc"[min(2, i // 50)]) for i in range(103)], "i long, s string")
    got = sampling.proportional_sample(df, "s", "i", 10).filter("in_sample").groupBy("s").count().collect()
    assert {r["s"]: r["count"] for r in got} == {"a": 5, "b": 5} and sampling.proportional_sample(df, "s", "i", 1000).filter("in_sample").count() == 103


def test_label_cap_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, f"k{rng.integers(150)}" if rng.random() > 0.1 else None, [str(x) for x in sorted(set(rng.integers(4, size=rng.integers(0, 3))))]) for i in range(200)]
    df = spark.createDataFrame(rows, "o long, k string, l array<string>")
    got = sorted(r["o"] for r in sampling.label_cap(df, "k", "o", "l", 5).collect())
    assert got == cap_by_brute_force(((o, k, lab) for o, k, lab in rows), 5)


def test_components_against_brute_force(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(200, size=(150, 2))] + [(7, 7), (0, 1), (0, 1)] + [(500, i) for i in range(501, 560)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["v"]: r["label"] for r in least_label(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {v: find(v) for v in parent}
    assert least_label(spark.createDataFrame([], "u long, v long")).count() == 0


def test_similar_pairs_exact(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 8))
    vectors = np.concatenate([base, base + 0.05 * rng.normal(size=base.shape)]).astype(np.float32)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)] + [(999, None)]
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for t in (0.95, 0.5):
        want = {(i, j) for i, j in zip(*np.nonzero(np.triu(unit @ unit.T >= t, 1)))}
        assert {(r["a"], r["b"]) for r in dedup.similar_pairs(df, threshold=t).collect()} == want
    assert dedup.similar_pairs(df.limit(0)).count() == 0


def test_chain_winner_and_cascade(spark):
    pairs = spark.createDataFrame([(1, 2, 0.99), (2, 3, 0.98)], "a long, b long, score double")
    records = spark.createDataFrame([(1, 10, 1), (2, 10, 0), (3, 11, 0), (4, 12, 5)], "id long, house long, label int")
    members = dedup.clusters(pairs)
    won = dedup.winners(members, records, "label")
    assert [tuple(r) for r in won.collect()] == [(1, 2, 3)]
    left, after = dedup.cascade(records, members, won)
    assert sorted(r["id"] for r in left.collect()) == [2, 4] and {r["house"]: r["left"] for r in after.collect()} == {10: 1, 11: 0, 12: 1}


def test_nearest_pairs_either_direction(spark):
    pairs = spark.createDataFrame([(1, 2, 0.9), (1, 3, 0.8), (2, 3, 0.7)], "a long, b long, score double")
    assert {(r["a"], r["b"]) for r in dedup.nearest_pairs(pairs, 1).collect()} == {(1, 2), (1, 3)}


def test_upsert_keeps_blank_and_repeats(spark):
    base = spark.createDataFrame([(1, "a", "x"), (2, None, "y"), (3, "b", "z")], "o long, k string, v string")
    changed = spark.createDataFrame([(1, "a", None), (2, "a", "new"), (3, "c", "p"), (4, "c", "q"), (5, None, "n")], "o long, k string, v string")
    got = sorted((r["k"] or "", r["v"], r["origin"]) for r in keyed.upsert(base, changed, "k", "o").collect())
    assert got == [("", "y", "base"), ("a", "new", "replaced"), ("b", "z", "base"), ("c", "p", "appended"), ("c", "q", "appended")]
    merged = keyed.merge_first_wins([base, changed], "k", "o").collect()
    assert sorted((r["k"] or "", r["v"]) for r in merged) == [("", "n"), ("", "y"), ("a", "x"), ("b", "z"), ("c", "p")]


def annotations(spark, rows):
    return spark.createDataFrame([(i, "P1", dt.datetime(2024, 1, i), f) for i, f in rows], "annotation_id long, officer_id string, annotated_at timestamp_ntz, fields map<string,string>")


def test_annotation_slots_and_enrichment(spark):
    notes = annotations(spark, [
        (1, {"house_id": "h1", "ext_img_1_db": "https://x/old.jpg"}),
        (2, {"house_id": "H1 ", "EXT_IMG_1": "https://x/f/a_0007.jpg", "ext_img_1_STATUS": "keep", "int_img_2_id": "IMG000008", "int_img_2_exists": "no", "ext_img_3_id": "IMG8", "anomaly_notes": "anomali 2"}),
        (3, {"house_id": "H2", "ext_img_1_db": "https://x/b.jpg", "ext_img_1_status": "DROP"}), (4, {"house_id": " "}), (5, {"house_id": "H9", "jenis_atap_terluas": "Seng"}),
    ])
    latest = reconcile.latest_annotations(notes)
    slots = reconcile.annotation_slots(latest)
    got = {(r["house_id"], r["side"], r["slot"]): (r["there"], r["kept"], r["view_type"]) for r in slots.collect()}
    assert got == {("H1", "ext", 1): (True, True, "interior"), ("H1", "int", 2): (False, True, "exterior"), ("H1", "ext", 3): (True, True, "interior"), ("H2", "ext", 1): (True, False, "exterior")}
    source = houses.houses(table(spark, [row(1, "H1", images=[image(image_path="f\\a_0007.jpg"), image(image_path="f/a_0008.jpg")]), row(2, "H2", images=[]), row(3, "H3")]))
    kept = reconcile.kept_images(slots, source.select("house_id", "images"))
    assert sorted((r["slot"], r["found_by"], r["source_pos"]) for r in kept.collect()) == [(1, "link", 0), (3, "id", 1)]
    assert sorted((r["house_id"], r["state"]) for r in reconcile.enrich(source, latest, kept).collect()) == [("H1", "rebuilt"), ("H3", "passed")]
    assert [r["house_id"] for r in reconcile.enrich(source, latest, kept, inner=True).collect()] == ["H1"]


def test_house_model(spark):
    rows = [row(1, "A", images=[image(view_type=" Exterior ", image_path="e", material_atap=" "), image(view_type="interior", image_path="i", material_atap="Rumbia")]), row(2, images=None), row(3, "B", images=[image(), None])]
    got = {r["rec_id"]: r for r in houses.houses(table(spark, rows)).collect()}
    assert got[1]["house_type"] == "multi" and got[1]["atap"] == "rumbia" and got[2]["house_type"] is None and got[2]["n_images"] == 0 and got[3]["n_images"] == 2
    fan = houses.fan_out(houses.houses(table(spark, rows)).filter("house_type = 'multi'")).collect()
    assert {(r["house_id"], r["image_path"]) for r in fan} == {("A_EXT", "e"), ("A_INT", "i")}


def test_profiles(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), (None, "x")], "p string, q string")
    assert {(r["p"], r["q"]) for r in missing_combos(df, ["p", "q"]).collect()} == {(None, None)}
    assert key_uniqueness(df, "p").first().asDict() == {"total_rows": 3, "non_null": 2, "null_rows": 1, "distinct_keys": 1, "repeated_keys": 1, "repeated_rows": 2}
    assert {(r["p"], r["x"], r["y"], r["total"]) for r in pivot_counts(df, ["p"], "q", ["x", "y"], "p").collect()} == {("a", 1, 0, 1), (None, 0, 0, 0)}


def test_chat(spark):
    df = spark.createDataFrame([("A", "Seng", None), ("B", "Seng", None), ("C", " tidak Terdeteksi", "Sesuai"), ("C", 'q"\nr', "Sesuai")], "letter string, label string, status string")
    got = df.select(chat.component("atap", F.col("letter"), F.col("label"), F.col("status")).alias("c")).select("c.*").collect()
    assert [(r["label"], r["status"], r["needs_text"]) for r in got] == [("Seng", "Tidak sesuai", True), ("Tidak terdeteksi", "Tidak teridentifikasi", False), ("Tidak terdeteksi", "Tidak teridentifikasi", False), ('q"\nr', "Sesuai", True)]
    assert "tampak luar tidak tersedia" in got[1]["reason"] and "tidak terlihat" in got[2]["reason"]
    texts = spark.createDataFrame([("```json\n```",), ("Maaf, tidak",), ("baik",), (None,)], "t string").select(chat.usable(F.col("t")).alias("u")).collect()
    assert [r["u"] for r in texts] == [False, False, True, False]


def test_answers_and_types(spark):
    from griyaflow.functions import payload
    from griyaflow.operators import augment

    rows = [('```json\n{"a": " x ", "b": {"alasan": "y"}}\n```',), ('{"a": "x\ny"}',), ("no",), (None,), ('{"a": null}',)]
    df = spark.createDataFrame(rows, "t string").select(payload.fenced_json(F.col("t")).alias("j")).select(payload.answer_field(F.col("j"), "a").alias("a"), payload.answer_field(F.col("j"), "b").alias("b"))
    assert [tuple(r) for r in df.collect()] == [("x", "y"), ("", ""), ("", ""), ("", ""), ("", "")]
    kinds = spark.createDataFrame([(" Exterior_only",), ("single",), ("odd",), (None,)], "k string")
    got = [tuple(r) for r in kinds.select(*[augment.type_reading(F.col("k"), r).alias(r) for r in ("split", "record", "output", "task")]).collect()]
    assert got == [("single_exterior_only", "single_exterior_only", "single_exterior_only", "multi"), ("single", "single", "multi", "single_exterior_only"), ("odd", "odd", "", "multi"), (None, "", "", "multi")]


def test_first_copy_hides_a_later_one(spark):
    from griyaflow.operators import augment

    rows = [row(1, "A", images=[image(image_path="p"), image(image_path="q", image_hash="h")]), row(2, "B", images=[image(image_path="p", image_hash="h"), image(image_path=" "), None])]
    got = augment.image_records(houses.houses(table(spark, rows))).collect()
    assert [(r["image_path"], r["house_id"], r["view_type"]) for r in got] == [("q", "A", "unknown")]


def test_minted_and_merged(spark):
    from griyaflow.operators import augment

    df = spark.createDataFrame([(i, k, "a", "b", "c") for i, k in enumerate(["multi", "single_exterior_only", "single_interior_only"])], "o long, house_type string, atap string, dinding string, lantai string")
    got = sorted(tuple(r) for r in augment.minted(df, "o", 99999).select("new_id", "atap", "dinding", "lantai").collect())
    nd = "Tidak Terdeteksi"
    assert got == [("H100000", "a", "b", nd), ("H100001", nd, nd, "c"), ("H99999", "a", "b", "c")]
    existing = spark.createDataFrame([("k1",), (None,)], "k string")
    source = spark.createDataFrame([(1, "k1", ["x"]), (2, "k2", ["x"]), (3, "k2", ["x"]), (4, None, ["x"]), (5, None, ["x"]), (6, "k9", [])], "o long, k string, l array<string>")
    merged = augment.merge_new(existing, source, source.filter("o = 6"), "k", "o", "l", 2)
    assert sorted((r["o"], r["origin"]) for r in merged.collect()) == [(2, "source"), (4, "source"), (6, "crawled")]


def test_winner_by_type_then_card_then_id_and_retyping(spark):
    records = spark.createDataFrame(
        [(1, "h1", "single_exterior_only", "k", "exterior"), (2, "h2", "multi", None, "exterior"), (3, "h2", "multi", None, "interior"), (4, "h3", "multi", "k", "interior"), (5, "h4", "odd", "k", "exterior")],
        "id long, house string, house_type string, no_kk string, view string",
    )
    members = spark.createDataFrame([(1, 1), (2, 1), (4, 1), (5, 1), (9, 1)], "id long, cluster long")
    won = dedup.winners(members, records, dedup.retain_order(F.col("house_type"), F.col("no_kk")))
    assert [tuple(r) for r in won.collect()] == [(1, 4, 4)]
    houses = spark.createDataFrame([("h1", "single_exterior_only"), ("h2", "multi"), ("h3", "multi"), ("h4", "odd"), ("h5", "multi")], "house string, house_type string")
    got = {r["house"]: (r["before"], r["left"], r["type_after"]) for r in dedup.cascade(records, members, won, houses)[1].collect()}
    assert got == {"h1": (1, 0, None), "h2": (2, 1, "single_interior_only"), "h3": (1, 1, "single_interior_only"), "h4": (1, 0, None), "h5": (0, 0, None)}
    assert sorted(r["loser"] for r in dedup.losers(members, won).collect()) == [1, 2, 5, 9]
