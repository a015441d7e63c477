"""Records against human annotations with dynamic keys.

An annotation is a map with keys like ``ext_img_1_status``; keys are read in any case, and the link of a slot may stand
under ``ext_img_1_db`` or ``ext_img_1``. The last annotation of a house counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from griyaflow.functions import text as X
from griyaflow.functions.keys import blank_to_null, house_key, non_empty, path_key
from griyaflow.functions.labels import COMPONENTS, NOT_DETECTED, SHOWN
from griyaflow.operators.ranking import best_per_key

SLOT_KEY = r"^(ext|int)_img_(\d+)(?:_(db|id|exists|status))?$"


def latest_annotations(df: DataFrame) -> DataFrame:
    """(annotation_id, house_id, fields) of the last annotation per house; without a house id, none."""
    rows = df.withColumn("house_id", house_key(F.col("fields")["house_id"])).filter("house_id is not null")
    return best_per_key(rows, ["house_id"], F.struct("annotated_at", "annotation_id"), last=True).select("annotation_id", "house_id", "fields")


def annotation_slots(latest: DataFrame) -> DataFrame:
    """One row per picture slot: side, number, link, picture id, whether it exists and is kept, the view it shows."""
    each = latest.select("annotation_id", "house_id", X.anomaly_mode(F.col("fields")["anomaly_notes"]).alias("mode"), F.explode("fields").alias("key", "value"))
    key = F.lower("key")
    part = lambda g: F.regexp_extract(key, SLOT_KEY, g)
    named = each.filter(key.rlike(SLOT_KEY)).select("annotation_id", "house_id", "mode", part(1).alias("side"), part(2).cast("int").alias("slot"), F.coalesce(non_empty(part(3)), F.lit("db")).alias("f"), "value")
    of = lambda f: F.max(F.when(F.col("f") == f, F.col("value"))).alias(f)
    slots = named.groupBy("annotation_id", "house_id", "mode", "side", "slot").agg(of("db"), of("id"), of("exists"), of("status"))
    link, pid = blank_to_null(F.col("db")), blank_to_null(F.col("id"))
    there = F.when(F.col("exists").isNull(), link.isNotNull() | pid.isNotNull()).otherwise(F.lower(X.strip(F.col("exists"))) == "yes")
    view = F.when(F.col("side") == "ext", "exterior").otherwise("interior")
    shown = F.when(F.col("mode") == "normal", view).otherwise(X.other_view(view))
    return slots.select("annotation_id", "house_id", "mode", "side", "slot", link.alias("link"), pid.alias("image_id"), there.alias("there"), X.keeps(F.col("status")).alias("kept"), shown.alias("view_type"))


def _number(col: Column, pattern: str) -> Column:
    return F.regexp_extract(col, pattern, 1).try_cast("long")


def kept_images(slots: DataFrame, sources: DataFrame) -> DataFrame:
    """Kept slots with the source picture found by link, else by id, else none. ``sources``: (house_id, images)."""
    pictures = sources.select("house_id", F.posexplode("images").alias("pos", "i")).select("house_id", "pos", path_key(F.col("i.image_path")).alias("path"))
    pictures = pictures.filter("path is not null").withColumn("number", _number(F.col("path"), r"_(\d+)\."))
    by_link = pictures.groupBy("house_id", "path").agg(F.max("pos").alias("link_pos"))
    by_id = pictures.filter("number is not null").groupBy("house_id", "number").agg(F.max("pos").alias("id_pos"))
    rows = slots.filter("there and kept").withColumn("path", F.lower(F.regexp_extract("link", r"^https?://[^/]+/(.*)$", 1))).withColumn("number", _number(F.col("image_id"), r"(\d+)"))
    found = rows.join(by_link, ["house_id", "path"], "left").join(by_id, ["house_id", "number"], "left")
    how = F.when(F.col("link_pos").isNotNull(), "link").when(F.col("id_pos").isNotNull(), "id").otherwise("default")
    return found.select("annotation_id", "house_id", "side", "slot", "view_type", how.alias("found_by"), F.coalesce("link_pos", "id_pos").alias("source_pos"))


def enrich(sources: DataFrame, latest: DataFrame, kept: DataFrame, inner: bool = False) -> DataFrame:
    """Houses with their annotation: unmatched pass through (or go, if ``inner``), matched ones without a kept picture go."""
    counts = kept.groupBy("annotation_id").agg(F.count("*").alias("n_kept"))
    right = latest.join(counts, "annotation_id", "left").select("house_id", F.col("annotation_id"), F.coalesce("n_kept", F.lit(0)).alias("n_kept"), "fields")
    joined = sources.join(right, "house_id", "inner" if inner else "left")
    return joined.filter("annotation_id is null or n_kept > 0").withColumn("state", F.when(F.col("annotation_id").isNull(), "passed").otherwise("rebuilt"))


def reconciled_labels(rows: DataFrame) -> DataFrame:
    """Annotated label, else the source's; components that the house type cannot show are not detected."""
    out = {}
    for c in COMPONENTS:
        label = F.coalesce(X.detected(F.col("fields")[f"jenis_{c}_terluas"]), X.detected(F.col(c)))
        hidden = [k for k, shown in SHOWN.items() if c not in shown]
        out[f"final_{c}"] = F.when(F.col("house_type").isin(*hidden), NOT_DETECTED).otherwise(label)
    return rows.withColumns(out)
