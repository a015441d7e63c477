import json

import pyarrow as pa

from griyaflow.operators.nested import child_rows, decode_payloads, flat_tables, flat_typed
from tests.houses import clashing, image, row, table

IMG = {"image_path": "a/b.jpg", "view_type": "exterior"}


def found(spark, *payloads):
    df = clashing(spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "raw_id long, payload string"), "id", "entity", "item_key", "house_id")
    return sorted(tuple(r) for r in flat_tables(df, columns=("house_pos", "entity", "item_pos", "item_key")).collect())


def test_shapes(spark):
    house = {"house_id": "H1", "pair_key": {"stem": 51}, "images": [IMG, {"image_path": None}]}
    expected = [(0, "house", 0, "H1"), (0, "image", 0, "exterior|a/b.jpg"), (0, "image", 1, "|"), (0, "pair_key", 0, "51")]
    for payload in (house, [house], {"data": [house]}, {"kiriman": {"petugas": "x", "records": [house]}}, json.dumps(house), {"houses": json.dumps([house])}, [json.dumps(house)]):
        assert [r[1:] for r in found(spark, json.dumps(payload))] == expected
    as_text = house | {"images": json.dumps(house["images"]), "pair_key": json.dumps(house["pair_key"])}
    assert [r[1:] for r in found(spark, json.dumps(as_text))] == expected


def test_views_and_single_image(spark):
    by_view = {"house_id": "H1", "images": {"interior": [{"image_path": "i"}], "exterior": [{"image_path": "e", "view_type": "other"}]}}
    assert [r[2:] for r in found(spark, json.dumps(by_view))] == [("house", 0, "H1"), ("image", 0, "exterior|e"), ("image", 1, "interior|i")]
    assert found(spark, json.dumps({"house_id": None, "images": IMG}))[1][2:] == ("image", 0, "exterior|a/b.jpg")


def test_positions_count_houses(spark):
    payload = [{"house_id": "A", "images": []}, None, {"house_id": "B", "pair_key": {"stem": None}, "images": None}, {"house_id": True}]
    assert [r[1:] for r in found(spark, json.dumps(payload))] == [(0, "house", 0, "A"), (1, "house", 0, "B"), (2, "house", 0, "true")]


def test_nothing(spark):
    bad = ["", "null", "[]", "3", "<html>", '[{"house_id": "A"', '{"house_id": NaN}', "[" * 5000]
    assert found(spark, None, *bad) == []
    assert flat_tables(spark.createDataFrame([], "raw_id long, payload string")).count() == 0


def test_written_numbers_long_and_repeated(spark):
    long = "x" * 1_000_000
    payload = '{"house_id": 1.50, "images": [{"image_path": "%s", "view_type": 1e3}]}' % long
    rows = found(spark, payload, payload)
    assert [r[3:] for r in rows if r[2] == "house"] == [(0, "1.50")] * 2
    assert {r[4] for r in rows if r[2] == "image"} == {"1e3|" + long}
    assert found(spark, '{"house_id": "\\ud800"}')[0][4] == "�"


def test_child_rows_of_sliced_lists():
    lists = pa.array([[1], None, [2, 3], []]).slice(1)
    values, parent, pos = child_rows(lists)
    assert values.to_pylist() == [2, 3] and parent.tolist() == [1, 1] and pos.tolist() == [0, 1]
    assert len(decode_payloads([])) == 0


def test_typed(spark):
    df = table(spark, [row(1, "H1", pair=("layak", "7"), images=[image(image_path="p", view_type="v"), None]), row(2), row(3, images=[])])
    got = sorted(tuple(r) for r in flat_typed(df, columns=("entity", "item_pos", "item_key")).collect())
    assert got == [(1, "house", 0, "H1"), (1, "image", 0, "v|p"), (1, "image", 1, "|"), (1, "pair_key", 0, "7"), (2, "house", 0, ""), (3, "house", 0, "")]
