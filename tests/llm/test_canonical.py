from griyaflow.llm.canonical import canonical_map, canonical_mentions
from tests.houses import clashing, image, row, table

REF = [(1, "atap", "genteng tanah liat", ["clay tile"]), (2, "atap", "seng gelombang", None), (3, "dinding", "seng datar", []), (4, "lantai", "tanah", ["lemah", None]), (5, "lantai", "vinil", ["lantai pvc"]), (6, "dinding", "papan kayu", []), (7, "lantai", "papan kayu", ["geladak"])]

WORDS = ["atap", "dinding", "lantai", "dari", "bekas", "retak", "bocor", "kw2", "alas", "sebagian", "lepas"]


def ref(spark, rows=REF):
    return clashing(spark.createDataFrame(rows, "ref_id int, component string, label string, other_names array<string>"), "name", "t", "joined", "value", "tok")


def meaning(spark, *pairs):
    got = canonical_map(spark.createDataFrame(list(pairs), "component string, value string"), ref(spark), descriptive=WORDS).collect()
    return {(r["component"], r["value"]): r["ref_id"] for r in got}


def test_writings(spark):
    cases = {
        ("atap", "GENTENG_TANAH-LIAT"): 1, ("atap", "gentengtanahliat"): 1, ("atap", "tanah liat genteng"): 1, ("atap", "g3nt3ng t4nah liát"): 1, ("atap", "Atap dari gentng tnah liat bekas"): 1,
        ("atap", "[A] clay tlie (retak)"): 1, ("atap", "03 seng gelombang, bocor"): 2, ("atap", "seng datar"): 0, ("dinding", "seng gelombang"): 0, ("dinding", "Seng Datar kw2"): 3, ("lantai", "lantai pvc"): 5,
        ("lantai", "alas lantai pvc - sebagian lepas"): 5, ("lantai", "lantai tanah"): 4, ("lantai", "lmah"): 4, ("lantai", "papn kayu"): 7, ("dinding", "papn kayu"): 6, ("atap", "papan kayu"): 0, ("lantai", "foto buram"): 0,
        ("lantai", "17"): 0, ("lantai", "-"): 0, ("lantai", "nan"): 0, ("lantai", "x" * 20000): 0,
    }
    assert meaning(spark, *cases) == cases


def test_mentions(spark):
    images = [image(material_atap="seng gelombang", material_dinding=" Seng datar", material_lantai=" "), None, image(material_lantai="lemah")]
    df = clashing(table(spark, [row(1, images=images), row(1, images=images), row(2, images=None), row(3, images=[])]), "component", "value", "i", "salt")
    got, mapped = canonical_mentions(df, ref(spark))
    assert sorted((r["rec_id"], r["image_pos"], r["component"], r["ref_id"]) for r in got.collect()) == [(1, 0, "dinding", 3)] * 2 + [(1, 2, "lantai", 4)] * 2
    assert {r["value"]: r["n_mentions"] for r in mapped.collect()} == {" Seng datar": 2, "lemah": 2}


def test_empty(spark):
    got, _ = canonical_mentions(table(spark, []), ref(spark))
    assert got.count() == 0
    got, _ = canonical_mentions(table(spark, [row(1, images=[image(material_atap="x y")])]), ref(spark, []))
    assert [r["ref_id"] for r in got.collect()] == [0]


def test_descriptive_words_are_learnt(spark):
    """Noise that no list has: words beside many materials are left out, writings of a material's word are not."""
    labels = ["genteng keramik", "seng gelombang", "papan kayu", "anyaman bambu", "ubin teraso", "batu alam", "semen plester", "asbes"]
    rows = [(i, "lantai", x, None) for i, x in enumerate(labels, 1)]
    noise = ["{}", "{} mlengkung", "anyar {}", "{} krowak parah", "sisih kidul {}", "{} mlengkung krowak"]
    values = {n.format(x): i for i, x in enumerate(labels, 1) for n in noise} | {x.replace("a", "aa", 1) + " mlengkung": i for i, x in enumerate(labels, 1)} | {"anyar krowak": 0, "peteng dhedhet": 0}
    got = canonical_map(spark.createDataFrame([("lantai", v) for v in values], "component string, value string"), ref(spark, rows)).collect()
    assert sum(values[r["value"]] == r["ref_id"] for r in got) >= 0.95 * len(values), [(r["value"], r["ref_id"]) for r in got if values[r["value"]] != r["ref_id"]]
