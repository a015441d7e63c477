"""The house view that many queries and their SQL start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from griyaflow.functions.labels import COMPONENTS, SHOWN
from griyaflow.operators.houses import houses
from griyaflow.runtime import table


def house_view(spark: SparkSession, d: str) -> DataFrame:
    return houses(table(spark, d, "sample_15"))


def _has(view: str) -> str:
    return f"coalesce(len(list_filter(images, lambda i: lower(trim(i.view_type)) = '{view}')), 0) > 0"


_MATERIAL = ", ".join(f"list_filter(list_transform(images, lambda i: nullif(lower(trim(i.material_{c})), '')), lambda m: m IS NOT NULL)[1] AS {c}" for c in COMPONENTS)
#: A CTE ``h``; queries go on with SELECT or a comma and more CTEs.
HOUSES = f"""
WITH h AS (SELECT rec_id, nullif(upper(trim(house_id)), '') AS house_id,
  CASE lower(trim(split)) WHEN 'validation' THEN 'val' WHEN 'train' THEN 'train' WHEN 'val' THEN 'val' WHEN 'test' THEN 'test' END AS split,
  CASE WHEN {_has('exterior')} AND {_has('interior')} THEN 'multi' WHEN {_has('exterior')} THEN 'single_exterior_only' WHEN {_has('interior')} THEN 'single_interior_only' END AS house_type,
  {_MATERIAL}, coalesce(len(images), 0)::INT AS n_images, images, captured_at FROM sample_15)
"""
STRATUM = "CASE " + " ".join(f"WHEN house_type = '{k}' THEN '{k}' || " + " || ".join(f"'||{c}=' || coalesce({c}, 'None')" for c in shown) for k, shown in SHOWN.items()) + " END"
