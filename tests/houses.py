"""Small house tables for tests."""

from __future__ import annotations

import datetime as dt

IMAGE = "struct<image_hash:string,image_path:string,folder_name:string,view_type:string,material_atap:string,kondisi_atap:string,material_dinding:string,kondisi_dinding:string,material_lantai:string,kondisi_lantai:string>"
SCHEMA = f"{{id}} long, house_id string, kelayakan_rumah string, split string, dataset_scheme string, pair_key struct<kelayakan_rumah:string,stem:string>, source_group_id string, images array<{IMAGE}>, captured_at timestamp_ntz, ingested_at timestamp_ntz"
FIELDS = ("image_hash", "image_path", "folder_name", "view_type", "material_atap", "kondisi_atap", "material_dinding", "kondisi_dinding", "material_lantai", "kondisi_lantai")
DAY = dt.datetime(2024, 1, 1)


def image(**kw):
    return tuple(kw.get(f) for f in FIELDS)


def row(i, house=None, kel=None, split=None, group=None, images=None, day=0, scheme=None, pair=None):
    return (i, house, kel, split, scheme, pair, group, images, None if day is None else DAY + dt.timedelta(days=day), None)


def table(spark, rows, id_col="rec_id"):
    return spark.createDataFrame(rows, SCHEMA.format(id=id_col))


def clashing(df, *names):
    """The table with extra columns of the given names."""
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit("x") for n in names})
