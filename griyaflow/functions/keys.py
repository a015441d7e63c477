"""Normal forms of the record keys and enumerations of the house tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def non_empty(col: Column) -> Column:
    """Null for empty text. Spelt as a CASE: NULLIF plans a projection of its own below, which keeps scans from pruning nested fields."""
    return F.when(col != "", col)


def blank_to_null(col: Column) -> Column:
    """Null for null and for text without anything but spaces; otherwise the text trimmed of spaces."""
    return non_empty(F.trim(col))


def house_key(col: Column) -> Column:
    """House id trimmed and upper-cased, blank as null."""
    return blank_to_null(F.upper(col))


def choice(col: Column) -> Column:
    """Enumerated value trimmed, lower-cased, each run of space, ``-`` and ``_`` read as one ``_``; blank as null."""
    return non_empty(F.regexp_replace(F.lower(F.trim(col)), "[ _-]+", "_"))


def split_name(col: Column) -> Column:
    """``train``, ``val`` or ``test``; ``validation`` counts as ``val``, everything else is null."""
    low = F.lower(F.trim(col))
    return F.when(low == "validation", "val").when(low.isin("train", "val", "test"), low)


def path_key(col: Column) -> Column:
    """Image path trimmed, lower-cased, back-slashes read as slashes; blank as null."""
    return non_empty(F.replace(F.lower(F.trim(col)), F.lit("\\"), F.lit("/")))


def path_set(images: Column) -> Column:
    """Sorted distinct non-blank path keys of an image array; an absent array is the empty set."""
    paths = F.transform(images["image_path"], path_key)  # the field's array: a scan reads no other field
    return F.coalesce(F.array_sort(F.array_distinct(F.filter(paths, lambda p: p.isNotNull()))), F.array().cast("array<string>"))
