"""Queries p2_* (nested records) and p5_* (two copies), with their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from griyaflow.functions.keys import choice, house_key, path_set
from griyaflow.operators.iblt import difference_report, field_differences, latest_rows
from griyaflow.operators.nested import HOUSE_FIELDS, IMAGE_FIELDS, flat_tables, flat_typed
from griyaflow.runtime import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return flat_tables(table(spark, d, "raw_records"), columns=("house_pos", "entity", "item_pos", "item_key"))


def p2_houses(spark: SparkSession, d: str) -> DataFrame:
    return flat_tables(table(spark, d, "raw_records"), entities=("house",), columns=("house_pos", *HOUSE_FIELDS))


def p2_pair_keys(spark: SparkSession, d: str) -> DataFrame:
    return flat_tables(table(spark, d, "raw_records"), entities=("pair_key",), columns=("house_pos", "pair_kelayakan_rumah", "stem"))


def p2_images(spark: SparkSession, d: str) -> DataFrame:
    return flat_tables(table(spark, d, "raw_records"), entities=("image",), columns=("house_pos", "item_pos", *IMAGE_FIELDS))


def p2_sample_links(spark: SparkSession, d: str) -> DataFrame:
    """The flat tables of sample_15, whose records are typed."""
    return flat_typed(table(spark, d, "sample_15"), columns=("entity", "item_pos", "item_key"))


def _latest(spark: SparkSession, d: str, name: str, id_col: str) -> DataFrame:
    fields = {"kelayakan_rumah": F.coalesce(choice(F.col("kelayakan_rumah")), F.lit("")), "image_paths": path_set(F.col("images"))}
    return latest_rows(table(spark, d, name), house_key(F.col("house_id")), [F.col("captured_at"), F.col(id_col)], fields)


def _differences(spark: SparkSession, d: str) -> DataFrame:
    sides = _latest(spark, d, "sample_15", "rec_id"), _latest(spark, d, "sample_mirror", "mirror_id")
    diff = field_differences(*sides, ["kelayakan_rumah", "image_paths"])
    return difference_report(diff, "house_id", {"kelayakan_rumah": "kelayakan_rumah", "image_paths": "image_path"})


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _differences(spark, d).select("house_id", "field_name", "kind")


def p5_differences(spark: SparkSession, d: str) -> DataFrame:
    """As p5_found, with both sides' values."""
    return _differences(spark, d).withColumnsRenamed({"left_value": "main_value", "right_value": "mirror_value"})


def p5_summary(spark: SparkSession, d: str) -> DataFrame:
    return _differences(spark, d).groupBy("field_name", "kind").agg(F.count("*").alias("houses"))


QUERIES = {f.__name__: f for f in (p2_found, p2_houses, p2_pair_keys, p2_images, p2_sample_links, p5_found, p5_differences, p5_summary)}

_SIDE = """
  SELECT k, kel, paths FROM (
    SELECT upper(trim(house_id)) AS k,
      coalesce(regexp_replace(lower(trim(kelayakan_rumah)), '[ _-]+', '_', 'g'), '') AS kel,
      coalesce(list_sort(list_distinct(list_filter(list_transform(images, lambda i: replace(lower(trim(i.image_path)), '\\', '/')), lambda p: p IS NOT NULL AND p <> ''))), []) AS paths,
      row_number() OVER (PARTITION BY upper(trim(house_id)) ORDER BY captured_at DESC NULLS LAST, {id} DESC) AS rn
    FROM {t} WHERE trim(house_id) <> '') WHERE rn = 1"""

_FOUND5 = f"""
WITH a AS ({_SIDE.format(id="rec_id", t="sample_15")}), b AS ({_SIDE.format(id="mirror_id", t="sample_mirror")}),
j AS (SELECT coalesce(a.k, b.k) AS house_id, a.k AS ak, b.k AS bk, a.kel AS akel, b.kel AS bkel, a.paths AS ap, b.paths AS bp FROM a FULL JOIN b ON a.k = b.k),
f AS (SELECT house_id, 'house_id' AS field_name, CASE WHEN bk IS NULL THEN 'missing_in_mirror' ELSE 'missing_in_main' END AS kind FROM j WHERE ak IS NULL OR bk IS NULL
UNION ALL SELECT house_id, 'kelayakan_rumah', 'differs' FROM j WHERE ak IS NOT NULL AND bk IS NOT NULL AND akel <> bkel
UNION ALL SELECT house_id, 'image_path', 'differs' FROM j WHERE ak IS NOT NULL AND bk IS NOT NULL AND ap <> bp)
"""

_ITEMS = """
SELECT rec_id, 'house' AS entity, 0::INT AS item_pos, coalesce(house_id, '') AS item_key FROM sample_15
UNION ALL SELECT rec_id, 'pair_key', 0::INT, pair_key.stem FROM sample_15 WHERE pair_key.stem IS NOT NULL
UNION ALL SELECT rec_id, 'image', (u.p - 1)::INT, coalesce(images[u.p].view_type, '') || '|' || coalesce(images[u.p].image_path, '')
FROM sample_15, unnest(range(1, len(images) + 1)) AS u(p)
"""

SQL = {
    "p5_found": _FOUND5 + "SELECT * FROM f",
    "p5_differences": _FOUND5
    + """SELECT f.*, CASE WHEN kind = 'missing_in_main' THEN NULL WHEN field_name = 'house_id' THEN house_id WHEN field_name = 'image_path' THEN '[' || array_to_string(ap, ', ') || ']' ELSE akel END AS main_value,
CASE WHEN kind = 'missing_in_mirror' THEN NULL WHEN field_name = 'house_id' THEN house_id WHEN field_name = 'image_path' THEN '[' || array_to_string(bp, ', ') || ']' ELSE bkel END AS mirror_value FROM f JOIN j USING (house_id)""",
    "p5_summary": _FOUND5 + "SELECT field_name, kind, count(*) AS houses FROM f GROUP BY 1, 2",
    "p2_sample_links": _ITEMS,
}
