"""Cell, code, label, link and flag rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell contents that stand for nothing.
EMPTY_CELLS = ("", "nan", "none", "null", "[]", "[ ]")
EMPTY_TEXTS = ("", "nan", "none", "null")


def strip(col: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def normalize_cell(col: Column) -> Column:
    text = strip(col)
    return F.when(~F.lower(text).isin(*EMPTY_CELLS), text)


def clean_card_number(col: Column) -> Column:
    """Card number as text: nothing-words to null, one trailing ``.0`` of a spreadsheet dropped."""
    text = strip(col)
    return F.when(~F.lower(text).isin(*EMPTY_TEXTS), F.regexp_replace(text, r"\.0$", ""))


def digits_code(col: Column) -> Column:
    """All digits of a cell as a number without leading zeros ("1.0" gives "10"); none gives null."""
    digits = F.regexp_replace(col, r"\D", "")
    bare = F.regexp_replace(digits, "^0+", "")
    return F.when(digits != "", F.when(bare == "", "0").otherwise(bare))


def spreadsheet_code(col: Column) -> Column:
    """Integral floats as integers ("1.0" gives "1"), other text stripped as it is; blank gives null."""
    text = strip(col)
    return F.when(text.rlike(r"^\d+\.0$"), F.regexp_replace(text, r"\.0$", "")).when(text != "", text)


def label_of_code(col: Column, labels: dict[str, str]) -> Column:
    """Label of a code; missing and unknown codes are ``unclassified``."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in labels.items() for x in kv]), digits_code(col)), F.lit("unclassified"))


def links_of_cell(col: Column) -> Column:
    """Links of a spreadsheet cell ``[a, b]``: brackets and quotes off, http(s) only, empty folders dropped."""
    text = strip(col)
    inner = F.when(text.startswith("[") & text.endswith("]") & (F.length(text) >= 2), strip(F.substring(text, 2, F.length(text) - 2))).otherwise(text)
    parts = F.transform(F.split(inner, ","), lambda p: F.regexp_replace(F.regexp_replace(strip(p), "^'+|'+$", ""), '^"+|"+$', ""))
    good = F.filter(parts, lambda p: (p.startswith("http://") | p.startswith("https://")) & ~p.endswith("prefix="))
    return F.coalesce(good, F.array().cast("array<string>"))


def urls_in_text(col: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(col, F.lit(r"https?://[^\s,\]\[]+"), 0), F.array().cast("array<string>"))


def url_path(col: Column) -> Column:
    return F.regexp_extract(col, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def url_extension(col: Column, default: str = ".jpg") -> Column:
    suffix = F.regexp_extract(F.regexp_extract(url_path(col), r"([^/]*)$", 1), r"[^.](\.[^.]+)$", 1)
    return F.when(suffix != "", suffix).otherwise(default)


def object_url(base: str, bucket: str, name: Column) -> Column:
    return F.concat(F.lit(base.rstrip("/") + f"/{bucket}/"), name)


def label_key(col: Column) -> Column:
    """Form in which labels are compared: stripped, lower case, ``_`` and runs of white space as one space."""
    return F.regexp_replace(F.replace(F.lower(strip(col)), F.lit("_"), F.lit(" ")), r"\s+", " ")


def canonical_label(col: Column, labels: dict[str, str]) -> Column:
    """The label that the map has for the text's key; blank stays blank, unknown text stays as stripped."""
    raw = strip(col)
    out = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in labels.items() for x in kv]), label_key(col)), raw)
    return F.when(raw == "", "").when(F.lower(raw) == "unclassified", "unclassified").otherwise(out)


def detected(col: Column) -> Column:
    """Label with blank as null and every spelling of "not detected" as one."""
    raw = strip(col)
    return F.when(F.lower(raw) == "tidak terdeteksi", "Tidak terdeteksi").when(raw != "", raw)


def anomaly_flag(notes: Column, n: int) -> Column:
    return F.coalesce(F.lower(notes).rlike(rf"\banomal[iy][_\s-]?{n}\b"), F.lit(False))


def anomaly_mode(notes: Column) -> Column:
    return F.when(anomaly_flag(notes, 1), "swap_slots").when(anomaly_flag(notes, 2), "flip_kept_images").otherwise("normal")


def other_view(col: Column) -> Column:
    return F.when(col == "exterior", "interior").when(col == "interior", "exterior").otherwise(col)


def keeps(status: Column) -> Column:
    """Whether an annotated picture stays: no status keeps it."""
    return F.coalesce(F.upper(strip(status)) == "KEEP", F.lit(True))


def comparison_status(predicted: Column, target: Column) -> Column:
    """Whether two labels agree; unidentified where either is missing or not detected."""
    p, t = detected(predicted), detected(target)
    missing = p.isNull() | t.isNull() | (p == "Tidak terdeteksi") | (t == "Tidak terdeteksi")
    return F.when(missing, "Tidak teridentifikasi").when(p == t, "Sesuai").otherwise("Tidak sesuai")


def mime_type(path: Column) -> Column:
    low = F.lower(path)
    return F.when(low.endswith(".png"), "image/png").when(low.endswith(".webp"), "image/webp").when(low.rlike(r"\.jpe?g$"), "image/jpeg").otherwise("image/jpeg")
