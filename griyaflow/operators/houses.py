"""The nested house model: views, types, labels and slots of the images array."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from griyaflow.functions.keys import house_key, split_name
from griyaflow.functions.labels import COMPONENTS, SHOWN


def view_of(image: Column) -> Column:
    return F.lower(F.trim(image["view_type"]))


def has_view(images: Column, view: str) -> Column:
    # the field's array, not the pictures: a scan reads no other field
    return F.coalesce(F.exists(images["view_type"], lambda v: F.coalesce(F.lower(F.trim(v)) == view, F.lit(False))), F.lit(False))


def house_type(images: Column, otherwise: Column | None = None) -> Column:
    """Type by the views that the pictures show; ``otherwise`` where they show none."""
    ext, inn = has_view(images, "exterior"), has_view(images, "interior")
    return F.when(ext & inn, "multi").when(ext, "single_exterior_only").when(inn, "single_interior_only").otherwise(F.lit(None).cast("string") if otherwise is None else otherwise)


def of_view(images: Column, view: str) -> Column:
    return F.filter(images, lambda i: view_of(i) == view)


def first_of_view(images: Column, view: str) -> Column:
    return F.get(of_view(images, view), F.lit(0))


def last_of_view(images: Column, view: str) -> Column:
    return F.try_element_at(of_view(images, view), F.lit(-1))


def first_material(images: Column, component: str) -> Column:
    """First non-blank material of a component over the pictures, trimmed and lower-cased."""
    each = F.transform(images[f"material_{component}"], lambda m: F.lower(F.trim(m)))
    return F.get(F.filter(each, lambda m: m != ""), F.lit(0))


def houses(df: DataFrame) -> DataFrame:
    """(rec_id, house_id, split, house_type, atap, dinding, lantai, n_images, images) of the old house schema."""
    return df.select(
        "rec_id", house_key(F.col("house_id")).alias("house_id"), split_name(F.col("split")).alias("split"), house_type(F.col("images")).alias("house_type"),
        *[first_material(F.col("images"), c).alias(c) for c in COMPONENTS], F.coalesce(F.array_size("images.view_type"), F.lit(0)).alias("n_images"), "images", "captured_at",
    )


def stratum(house_type_col: str = "house_type") -> Column:
    """Key text of a stratum: the type and the labels of the components that its pictures can show."""
    out = F.lit(None).cast("string")
    for kind, shown in SHOWN.items():
        text = F.concat(F.lit(kind), *[F.concat(F.lit(f"||{c}="), F.coalesce(F.col(c), F.lit("None"))) for c in shown])
        out = F.when(F.col(house_type_col) == kind, text).otherwise(out)
    return out


def slots(images: Column, per_view: int = 2) -> list[tuple[str, Column]]:
    """Positional slots: (name, path or empty) of up to ``per_view`` pictures of each view."""
    out = []
    for view, short in (("exterior", "ext"), ("interior", "int")):
        own = of_view(images, view)
        out += [(f"{short}_img_{k + 1}", F.coalesce(F.get(own, F.lit(k))["image_path"], F.lit(""))) for k in range(per_view)]
    return out


def fan_out(df: DataFrame) -> DataFrame:
    """One record per shown view: houses of both views become an ``_EXT`` and an ``_INT`` record."""
    each = []
    for view, tag in (("exterior", "_EXT"), ("interior", "_INT")):
        picture = first_of_view(F.col("images"), view)
        each.append(F.when(picture.isNotNull(), F.struct(F.concat(F.col("house_id"), F.lit(tag)).alias("house_id"), F.lit(f"single_{view}_only").alias("house_type"), picture["image_path"].alias("image_path"))))
    return df.select("rec_id", F.explode(F.array_compact(F.array(*each))).alias("r")).select("rec_id", "r.*")
