"""Extending a record set from crawled pictures: candidate pools, minted records, the whole merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from griyaflow.functions.keys import non_empty
from griyaflow.functions.labels import COMPONENTS, NOT_DETECTED_MINTED, SHOWN
from griyaflow.functions.text import strip
from griyaflow.operators.ranking import global_rank
from griyaflow.operators.sampling import label_cap


def short_label(col: Column) -> Column:
    """Lower-case label, nothing-words as null, the long thatch label by its first word."""
    low = F.lower(strip(col))
    return F.when(low == "jerami/ijuk/daun-daunan/rumbia", "jerami").when(~low.isin("", "none", "null"), low)


# How house types were written, and what each reader makes of them.
_FULL = {"multi": "multi", "single_exterior_only": "single_exterior_only", "single_interior_only": "single_interior_only", "exterior_only": "single_exterior_only", "interior_only": "single_interior_only"}


def type_reading(col: Column, reader: str) -> Column:
    """House type as ``split`` (blank null, unknown kept), ``record`` (unknown kept), ``output`` (``single`` is multi,
    unknown empty) or ``task`` (``single`` is exterior, unknown multi) readers take it."""
    low = F.lower(strip(F.coalesce(col, F.lit(""))))
    table = {"output": _FULL | {"single": "multi"}, "task": {k: v for k, v in _FULL.items() if k in SHOWN} | {"single": "single_exterior_only"}}.get(reader, _FULL)
    out = {"split": non_empty(low), "record": low, "output": F.lit(""), "task": F.lit("multi")}[reader]
    for k, v in table.items():
        out = F.when(low == k, v).otherwise(out)
    return out


def allowed(kind: Column, labels: dict[str, Column], lists: dict[str, tuple[str, ...]]) -> Column:
    """Whether any label that the type can show is on its component's list; missing labels are not."""
    out = F.lit(False)
    for k, shown in SHOWN.items():
        hit = F.lit(False)
        for c in shown:
            hit = hit | F.coalesce(labels[c].isin(*lists[c]), F.lit(False))
        out = F.when(kind == k, hit).otherwise(out)
    return out


def valid_images(kind: Column, images: Column) -> Column:
    """Records of both views need a picture of each, others any picture."""
    from griyaflow.operators.houses import has_view

    both = has_view(images, "exterior") & has_view(images, "interior")
    return F.when(F.coalesce(kind, F.lit("")) == "multi", both).otherwise(F.coalesce(F.size(images) > 0, F.lit(False)))


def image_records(houses: DataFrame, house: str = "house_id") -> DataFrame:
    """One row per picture path: the first record that holds it counts, and only then must it have a hash.

    The check comes after the choice: a first copy without one hides a later good one."""
    each = houses.select(house, "rec_id", F.posexplode("images").alias("pos", "i"))
    each = each.select(house, "rec_id", "pos", non_empty(F.trim("i.image_path")).alias("image_path"), non_empty(F.trim("i.image_hash")).alias("image_hash"), F.coalesce(non_empty(F.lower(F.trim("i.view_type"))), F.lit("unknown")).alias("view_type"))
    first = each.filter("image_path is not null").groupBy("image_path").agg(F.min_by(F.struct(house, "rec_id", "pos", "image_hash", "view_type"), F.struct("rec_id", "pos")).alias("f"))
    return first.select("image_path", "f.*").filter("image_hash is not null")


def minted(records: DataFrame, order: str, first_house: int, prefix: str = "H") -> DataFrame:
    """Records with running house ids from ``first_house`` on; labels that are missing or that the type cannot show are not detected."""
    numbered = global_rank(records, [order], "_n")
    out = {c: F.when(F.col("house_type").isin(*[k for k, shown in SHOWN.items() if c not in shown]), NOT_DETECTED_MINTED).otherwise(F.coalesce(F.col(c), F.lit(NOT_DETECTED_MINTED))) for c in COMPONENTS}
    return numbered.withColumns(out).withColumn("new_id", F.concat(F.lit(prefix), F.format_string("%05d", F.col("_n") + first_house - 1))).drop("_n")


def merge_new(existing: DataFrame, source: DataFrame, crawled: DataFrame, key: str, order: str, labels: str, cap: int) -> DataFrame:
    """Source records with new keys, capped per label in order, then the crawled records as they are."""
    known = existing.select(key).filter(F.col(key).isNotNull()).distinct()
    new = label_cap(source, key, order, labels, cap, seen=known).withColumn("origin", F.lit("source"))
    return new.unionByName(crawled.withColumn("origin", F.lit("crawled")), allowMissingColumns=True)
