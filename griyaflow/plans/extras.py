"""Queries of answers, types, filters, picture records, minted records and the merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from griyaflow.functions import payload as Y
from griyaflow.functions.labels import COMPONENTS, SHOWN
from griyaflow.operators import augment as A
from griyaflow.operators.sampling import SPLITS
from griyaflow.plans.base import HOUSES, house_view
from griyaflow.runtime import table

C = F.col
LISTS = {"atap": ("rumbia", "ijuk aren", "alang-alang"), "dinding": ("anyaman bambu", "bilah pring"), "lantai": ("tanah", "galar bambu")}
READERS = ("split", "record", "output", "task")
FIELDS = ("komponen", "prediksi", "alasan")


def model_answers(spark: SparkSession, d: str) -> DataFrame:
    """Fields of the JSON answers among the documents."""
    rows = table(spark, d, "documents").select("doc_id", Y.fenced_json(C("text")).alias("j")).filter("j is not null")
    return rows.select("doc_id", *[Y.answer_field(C("j"), f).alias(f) for f in FIELDS])


def type_readings(spark: SparkSession, d: str) -> DataFrame:
    """How the four readers take the written type."""
    return table(spark, d, "sample_15").select("rec_id", *[A.type_reading(C("dataset_scheme"), r).alias(r) for r in READERS])


def record_filters(spark: SparkSession, d: str) -> DataFrame:
    """Which records have a split, an allowed label and the pictures that their type needs."""
    labels = {c: C(c) for c in COMPONENTS}
    return house_view(spark, d).select(
        "rec_id", (C("split").isNotNull() & C("split").isin(*SPLITS)).alias("has_split"), A.allowed(C("house_type"), labels, LISTS).alias("allowed"),
        A.valid_images(C("house_type"), C("images")).alias("pictures"), (F.lower(F.coalesce("dinding", F.lit(""))) == "anyaman bambu").alias("woven"),
    )


def image_records(spark: SparkSession, d: str) -> DataFrame:
    return A.image_records(house_view(spark, d)).select("image_path", "house_id", "rec_id", "pos", "view_type")


def minted_records(spark: SparkSession, d: str) -> DataFrame:
    """Test rows as new records: ids go on from 50,000, hidden labels forced."""
    rows = house_view(spark, d).filter("split = 'test' and house_type is not null").select("rec_id", "house_type", *COMPONENTS)
    return A.minted(rows, "rec_id", 50_000)


def merged_new(spark: SparkSession, d: str) -> DataFrame:
    """Copy rows with walls on the list and houses that the main table lacks, 20 per wall, then the test rows."""
    main = house_view(spark, d)
    mirror = house_view_of(table(spark, d, "sample_mirror").withColumnRenamed("mirror_id", "rec_id"))
    labels = F.array_compact(F.array(F.when(C("dinding").isNotNull(), C("dinding"))))
    train = main.filter("split = 'train'").select("house_id")
    source = mirror.filter("split is not null and split <> 'train'").select("rec_id", "house_id", labels.alias("labels"))
    crawled = main.filter("split = 'test'").select("rec_id", "house_id", labels.alias("labels"))
    return A.merge_new(train, source, crawled, "house_id", "rec_id", "labels", 20).select("rec_id", "house_id", "origin")


def house_view_of(df: DataFrame) -> DataFrame:
    from griyaflow.operators.houses import houses

    return houses(df)


def content_keys(spark: SparkSession, d: str) -> DataFrame:
    """How many annotations share their content."""
    key = Y.content_key(C("officer_id"), F.array_sort(F.map_entries("fields")).alias("fields"))
    return table(spark, d, "annotations").select(key.alias("k")).groupBy("k").agg(F.count("*").alias("n")).groupBy("n").agg(F.count("*").alias("keys"))


QUERIES = {f.__name__: f for f in (model_answers, type_readings, record_filters, image_records, minted_records, merged_new, content_keys)}


def _reading(reader: str) -> str:
    low = r"lower(regexp_replace(coalesce(dataset_scheme, ''), '^\s+|\s+$', '', 'g'))"
    table_ = {"output": A._FULL | {"single": "multi"}, "task": {k: v for k, v in A._FULL.items() if k in SHOWN} | {"single": "single_exterior_only"}}.get(reader, A._FULL)
    rest = {"split": f"nullif({low}, '')", "record": low, "output": "''", "task": "'multi'"}[reader]
    return f"CASE {low} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table_.items()) + f" ELSE {rest} END AS {reader}"


def _allowed() -> str:
    each = lambda c: f"coalesce({c} IN ({', '.join(repr(x) for x in LISTS[c])}), false)"
    return "CASE house_type " + " ".join(f"WHEN '{k}' THEN {' OR '.join(each(c) for c in shown)}" for k, shown in SHOWN.items()) + " ELSE false END"


_BARE = r"regexp_replace(regexp_replace(text, '```(json)?', '', 'g'), '^\s+|\s+$', '', 'g')"
SQL = {
    "model_answers": f"WITH j AS (SELECT doc_id, {_BARE} AS j FROM documents WHERE starts_with({_BARE}, '{{') AND ends_with({_BARE}, '}}')) SELECT doc_id, " + ", ".join(rf"regexp_replace(coalesce(CASE WHEN json_valid(j) THEN json_extract_string(j, '$.{f}') END, ''), '^\s+|\s+$', '', 'g') AS {f}" for f in FIELDS) + " FROM j",
    "type_readings": "SELECT rec_id, " + ", ".join(_reading(r) for r in READERS) + " FROM sample_15",
    "record_filters": HOUSES + f"SELECT rec_id, split IS NOT NULL AS has_split, {_allowed()} AS allowed, CASE WHEN house_type = 'multi' THEN true ELSE n_images > 0 END AS pictures, lower(coalesce(dinding, '')) = 'anyaman bambu' AS woven FROM h",
    "image_records": HOUSES + ", e AS (SELECT house_id, rec_id, u.p - 1 AS pos, images[u.p] AS i FROM h, unnest(range(1, len(images) + 1)) AS u(p)), f AS (SELECT nullif(trim(i.image_path), '') AS image_path, house_id, rec_id, pos, nullif(trim(i.image_hash), '') AS hash, coalesce(nullif(lower(trim(i.view_type)), ''), 'unknown') AS view_type, row_number() OVER (PARTITION BY nullif(trim(i.image_path), '') ORDER BY rec_id, pos) AS rn FROM e) SELECT image_path, house_id, rec_id, pos::INT AS pos, view_type FROM f WHERE rn = 1 AND image_path IS NOT NULL AND hash IS NOT NULL",
    "minted_records": HOUSES + "SELECT rec_id, house_type, " + ", ".join(f"CASE WHEN house_type IN ({', '.join(repr(k) for k, shown in SHOWN.items() if c not in shown)}) THEN 'Tidak Terdeteksi' ELSE coalesce({c}, 'Tidak Terdeteksi') END AS {c}" for c in COMPONENTS) + ", 'H' || printf('%05d', 49999 + row_number() OVER (ORDER BY rec_id)) AS new_id FROM h WHERE split = 'test' AND house_type IS NOT NULL",
    "content_keys": "SELECT n, count(*) AS keys FROM (SELECT count(*) AS n FROM (SELECT officer_id, list_sort(map_entries(fields)) AS f FROM annotations) GROUP BY officer_id, f) GROUP BY 1",
}
