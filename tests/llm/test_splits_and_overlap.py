import numpy as np
from pyspark.sql import functions as F

from griyaflow.llm import linked_splits, overlap
from tests.houses import clashing, image, row, table


def parted(spark, rows):
    return sorted(r["rec_id"] for r in linked_splits.parted_rows(clashing(table(spark, rows), "h", "g", "s", "n", "pid", "component")).collect())


def test_links(spark):
    rows = [
        row(1, "h1_EXT", split="train", group="g1"), row(2, " H1_int ", split="VALIDATION "), row(3, None, split=None, group=" G1"),
        row(4, "H2", split="train", group="unknown"), row(5, "H3", split="test", group="Unknown "), row(6, " ", split="test", group="nan"),
        row(7, "H4", split="train", group="g2"), row(8, "H4", split="holdout", group="g3"), row(9, "H5", split="train", group="g3"), row(10, "H6", split="test", group="g4"),
        row(11, "H6", split="test", group="g5"), row(12, "H7", split="val", group="g5"), row(13, "H1_EXT_INT", split="train"), row(14, None, split="val"),
    ]
    assert parted(spark, rows) == [1, 2, 3, 10, 11, 12]
    assert parted(spark, []) == []


def brute(rows):
    """Linked sets by union-find over (house, group) keys."""
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for _, h, g, _ in rows:
        if h and g:
            parent[find("h" + h)] = find("g" + g)
    return {i: find("h" + h if h else "g" + g) if h or g else f"r{i}" for i, h, g, _ in rows}


def random_rows(seed, n=600):
    rng = np.random.default_rng(seed)
    pick = lambda p, k: None if rng.random() < p else str(rng.integers(k))
    hot = lambda i: "hot" if i % 3 == 0 else None
    return [(i, pick(0.1, 250), hot(i) or pick(0.3, 250), ("train", "val", "test", None)[rng.integers(4)]) for i in range(n)]


def test_against_brute_force_with_a_hot_group(spark):
    rows = random_rows(1)
    of = brute(rows)
    seen = {}
    for i, _, _, s in rows:
        seen.setdefault(of[i], set()).update({s} - {None})
    want = sorted(i for i, *_ in rows if len(seen[of[i]]) > 1)
    assert parted(spark, [row(i, h, split=s, group=g) for i, h, g, s in rows]) == want


def test_assignment_keeps_sets_whole_and_shares(spark):
    rng = np.random.default_rng(4)
    rows = [(i, str(rng.integers(900)), "hot" if i % 10 == 0 else f"g{rng.integers(2000)}", None) for i in range(3000)]
    of = brute(rows)
    got = linked_splits.assign_splits(table(spark, [row(i, h, group=g) for i, h, g, _ in rows] + [row(9000, None), row(9000, None)]), [("train", 0.8), ("val", 0.1), ("test", 0.1)]).collect()
    assert len(got) == 3002
    splits = {}
    for r in got:
        if r["rec_id"] < 9000:
            splits.setdefault(of[r["rec_id"]], set()).add(r["new_split"])
    assert all(len(s) == 1 for s in splits.values())
    largest = max(sum(1 for i in of if of[i] == c) for c in set(of.values()))
    train = sum(r["new_split"] == "train" for r in got)
    assert abs(train - 2400) <= largest


def test_equal_sets_take_their_shares(spark):
    got = linked_splits.assign_splits(table(spark, [row(i, f"H{i}") for i in range(1000)]), [("train", 8.0), ("val", 1.0), ("test", 1.0)]).groupBy("new_split").count().collect()
    assert {r["new_split"]: r["count"] for r in got} == {"train": 800, "val": 100, "test": 100}
    assert linked_splits.assign_splits(table(spark, []), [("train", 1.0)]).count() == 0


def flip(h, *bits):
    x = int(h, 16)
    for b in bits:
        x ^= 1 << int(b)
    return f"{x:064x}"


HOLD = "f" * 64


def pairs(spark, rows):
    place = spark.createDataFrame([(HOLD,), (None,)], "image_hash string")
    got = overlap.overlapping_pairs(clashing(table(spark, rows), "id", "h", "train", "side", "bits", "salt", "w0"), place)
    return sorted((r["train_id"], r["eval_id"], r["bits"]) for r in got.collect())


def test_hash_rules(spark):
    a = "0123456789abcdef" * 4
    img = lambda *h: [image(image_hash=x) for x in h]
    rows = [
        row(1, split=" Train", images=img(f" PHASH:{a.upper()} ", a)), row(2, split="validation", images=img(a)), row(3, split="test", images=img(flip(a, *range(0, 200, 20)))),
        row(4, split="test", images=img(flip(a, *range(0, 220, 20)))), row(5, split="holdout", images=img(a)), row(6, split="val", images=img(a[:-1], None, " ", HOLD)),
        row(7, split="train", images=img(HOLD)), row(8, split="test", images=None), row(9, split=None, images=img(a)), row(10, split="train", images=[]), row(11, split="test", images=img(HOLD.upper())),
    ]
    assert pairs(spark, rows) == [(1, 2, 0), (1, 3, 10)]
    assert pairs(spark, []) == []


def test_against_brute_force_with_a_picture_in_a_third_of_rows(spark):
    rng = np.random.default_rng(7)
    base = [f"{int.from_bytes(rng.bytes(32), 'big'):064x}" for _ in range(25)]
    rows = []
    for i in range(240):
        h = base[0] if i % 3 == 0 else base[rng.integers(25)]
        rows.append((i, ("train", "val", "test")[rng.integers(3)], flip(h, *rng.choice(256, size=rng.integers(0, 9), replace=False))))
    want = []
    for i, s, h in rows:
        for j, t, g in rows:
            if s == "train" and t != "train" and (d := (int(h, 16) ^ int(g, 16)).bit_count()) <= 10:
                want.append((i, j, d))
    assert pairs(spark, [row(i, split=s, images=[image(image_hash=h)]) for i, s, h in rows]) == sorted(want)


def test_blocks_cover_all_bits():
    blocks = overlap.block_starts(11)
    assert len(blocks) == 11 and blocks[0][0] == 0 and sum(k for _, k in blocks) == 256 and all(a + n == b for (a, n), (b, _) in zip(blocks, blocks[1:]))


def test_turned_texts_and_prefixes(spark):
    rng = np.random.default_rng(8)
    texts = [f"{int.from_bytes(rng.bytes(32), 'big'):064x}" for _ in range(20)]
    rows = overlap.suffixes(spark.createDataFrame([(t, 1) for t in texts], "h string, side int").select("side", *overlap.hash_words("h")), 10).collect()
    bits = {f"{int(t, 16):0256b}" for t in texts}
    starts = [a for a, _ in overlap.block_starts(10 + 1)]
    turned = {(r["at"] >> 2, "".join(f"{r[f'r{i}'] % 2**64:064b}" for i in range(4))) for r in rows}
    assert turned == {(k, t[a:] + t[:a]) for t in bits for k, a in enumerate(starts)}
    r = np.array([[r[f"r{i}"] for i in range(4)] for r in rows]).view(np.uint64)
    back = overlap._turned_back(r, np.array([starts[x["at"] >> 2] for x in rows]))
    assert {"".join(f"{int(w):064b}" for w in x) for x in back} == bits
    x = r[:1].repeat(257, 0)
    y = x.copy()
    for i in range(256):
        y[i, i // 64] ^= np.uint64(1 << (63 - i % 64))
    assert overlap.common_prefix(x, y).tolist() == list(range(257))


def test_intervals_and_grid_find_what_brute_force_finds(spark, monkeypatch):
    rng = np.random.default_rng(9)
    base = [f"{int.from_bytes(rng.bytes(32), 'big'):064x}" for _ in range(20)]
    hashes = sorted({flip(base[rng.integers(20)], *rng.choice(256, size=rng.integers(0, 9), replace=False)) for _ in range(300)})
    words = spark.createDataFrame([(h, 1 + i % 3) for i, h in enumerate(hashes)], "h string, side int").select("side", *overlap.hash_words("h"))
    text = lambda r, n: "".join(f"{r[f'{n}{k}'] % 2**64:016x}" for k in range(4))
    side = {h: 1 + i % 3 for i, h in enumerate(hashes)}

    def covered(a, b):
        x, held = f"{int(a, 16) ^ int(b, 16):0256b}" + "1", set()
        for at, n in overlap.block_starts(11):
            stop = x.index("1", at)
            held |= set(range(at, stop)) if stop - at >= n else set()
        return len(held)

    want = {(a, b, d, covered(a, b)) for a in hashes for b in hashes if side[a] & 1 and side[b] & 2 and (d := (int(a, 16) ^ int(b, 16)).bit_count()) <= 10}
    for hot, block in ((1 << 22, 2048), (20, 2048), (20, 3)):
        monkeypatch.setattr(overlap, "HOT", hot)
        monkeypatch.setattr(overlap, "BLOCK", block)
        assert {(text(r, "t"), text(r, "e"), r["bits"], r["covered"]) for r in overlap.near_hashes(words).collect()} == want


def test_hot_interval_is_spread_over_tasks(spark):
    """100,000 texts with one block in common: a grid of cells, none with more than BLOCK of a side or so."""
    hot = spark.range(100_000).select(F.lit(0).cast("byte").alias("k"), F.lit(7).cast("long").alias("block"), F.lit(0).cast("long").alias("r0"), *[F.xxhash64("id", F.lit(i)).alias(f"r{i}") for i in (1, 2, 3)], F.when(F.col("id") % 5 == 0, 2).otherwise(1).cast("byte").alias("side"))
    found = overlap._grid(hot, 10)
    assert found.count() == 0
    sizes = overlap._placed(hot).groupBy("x", "y", "bit").count().agg(F.max("count").alias("most"), F.count("*").alias("cells")).first()
    assert sizes["most"] < 1.2 * overlap.BLOCK and sizes["cells"] == 2 * 40 * 10


def test_large_interval_is_compared_in_blocks(spark):
    n = 3000
    hashes = [(f"{7:08x}{i:056x}", 1 + i % 2) for i in range(n)]
    got = overlap.near_hashes(spark.createDataFrame(hashes, "h string, side int").select("side", *overlap.hash_words("h")), 1).count()
    want = sum(1 for i in range(0, n, 2) for b in range(12) if (i ^ (1 << b)) % 2 and (i ^ (1 << b)) < n)
    assert got == want


def test_report(spark):
    a = "0123456789abcdef" * 4
    rows = [row(1, split="train", images=[image(image_hash=a)]), row(2, split="test", group=" G ", images=[image(image_hash=flip(a, 3))]), row(3, split="test", group="g")]
    got = overlap.overlap_by_split(table(spark, rows), spark.createDataFrame([], "image_hash string")).collect()
    assert [(r["split"], r["source_group"], r["n_records"], r["n_overlapping"], r["n_exact"]) for r in got] == [("test", "g", 2, 1, 0)]
