"""Queries over cells, codes, labels, links and flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from griyaflow.functions import text as X
from griyaflow.functions.labels import COMPONENTS, code_table, label_map
from griyaflow.functions.urls import BLOCKED_HOSTS, BLOCKED_PARTS, IMAGE_ENDS, OTHER_ENDS, is_image_url
from griyaflow.operators.profile import change_audit
from griyaflow.runtime import table

C = F.col


def survey_normalized(spark: SparkSession, d: str) -> DataFrame:
    """Survey cells with nothing-words as null, card numbers cleaned."""
    cells = ["id_lantai_terluas", "id_dinding_terluas", "id_atap_terluas", "foto_rumah", "foto_rumah_tampak_dalam"]
    return table(spark, d, "survey_rows").select("survey_id", X.clean_card_number(C("no_kk")).alias("no_kk"), *[X.normalize_cell(C(c)).alias(c) for c in cells])


def survey_complete(spark: SparkSession, d: str) -> DataFrame:
    """Rows with no empty cell among the needed columns."""
    cols = ["no_kk", "id_lantai_terluas", "id_dinding_terluas", "id_atap_terluas", "foto_rumah"]
    return survey_normalized(spark, d).dropna("any", subset=cols).select("survey_id", *cols)


def code_to_label(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "survey_rows").select("survey_id", *[X.label_of_code(C(f"id_{c}_terluas"), code_table(c)).alias(c) for c in COMPONENTS])


def code_variants(spark: SparkSession, d: str) -> DataFrame:
    """The two readings of a code cell side by side."""
    return table(spark, d, "survey_rows").select("survey_id", X.digits_code(C("id_lantai_terluas")).alias("digits"), X.spreadsheet_code(C("id_lantai_terluas")).alias("cell"))


def survey_links(spark: SparkSession, d: str) -> DataFrame:
    """Every link of the survey's picture cells, with its place."""
    rows = table(spark, d, "survey_rows")
    views = F.explode(F.array(F.struct(F.lit("exterior").alias("view"), C("foto_rumah").alias("cell")), F.struct(F.lit("interior").alias("view"), C("foto_rumah_tampak_dalam").alias("cell"))))
    cells = rows.select("survey_id", views.alias("v"))
    return cells.select("survey_id", "v.view", F.posexplode(X.links_of_cell(C("v.cell"))).alias("pos", "url"))


def url_checks(spark: SparkSession, d: str) -> DataFrame:
    """Link rules over the survey's links and those inside texts."""
    links = survey_links(spark, d).select("url")
    texts = table(spark, d, "documents").select(F.explode(X.urls_in_text(C("text"))).alias("url"))
    urls = links.unionByName(texts).groupBy("url").agg(F.count("*").alias("n"))
    return urls.select("url", "n", is_image_url(C("url")).alias("is_image"), X.url_extension(C("url")).alias("extension"))


def ordered_links(spark: SparkSession, d: str) -> DataFrame:
    """Distinct links of documents by their first appearance."""
    each = table(spark, d, "documents").select("doc_id", F.posexplode(X.urls_in_text(C("text"))).alias("pos", "url"))
    first = each.groupBy("url").agg(F.min(F.struct("doc_id", "pos")).alias("f"))
    return first.select("url", C("f.doc_id").alias("first_doc"), C("f.pos").alias("first_pos"))


def parsed_props(spark: SparkSession, d: str) -> DataFrame:
    """JSON text of the events as a number, by event type."""
    k = F.try_to_number(F.get_json_object("props", "$.k"), F.lit("999999")).cast("long")
    return table(spark, d, "events").select("event_type", k.alias("k")).groupBy("event_type").agg(F.count("k").alias("n"), F.sum("k").alias("sum_k"), F.max("k").alias("max_k"))


def canonical_labels(spark: SparkSession, d: str) -> DataFrame:
    """Annotators' labels in the spelling of the lists."""
    rows = table(spark, d, "annotations")
    return rows.select("annotation_id", *[X.canonical_label(C("fields")[f"jenis_{c}_terluas"], label_map(c)).alias(c) for c in COMPONENTS])


def label_changes(spark: SparkSession, d: str) -> DataFrame:
    """How often the canonical spelling changes a label."""
    rows = table(spark, d, "annotations")
    cols = {f"old_{c}": C("fields")[f"jenis_{c}_terluas"] for c in COMPONENTS} | {f"new_{c}": X.canonical_label(C("fields")[f"jenis_{c}_terluas"], label_map(c)) for c in COMPONENTS}
    return change_audit(rows.select(*[v.alias(k) for k, v in cols.items()]), {c: (f"old_{c}", f"new_{c}") for c in COMPONENTS})


def anomaly_modes(spark: SparkSession, d: str) -> DataFrame:
    notes = C("fields")["anomaly_notes"]
    return table(spark, d, "annotations").select("annotation_id", *[X.anomaly_flag(notes, n).alias(f"flag_{n}") for n in (1, 2, 3, 4)], X.anomaly_mode(notes).alias("mode"))


def next_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Where numbering of houses and pictures goes on: greatest number in use plus one."""
    rows = table(spark, d, "sample_15")
    house = rows.agg(F.max(F.regexp_extract("house_id", r"(\d+)", 1).try_cast("long")).alias("m")).select(F.lit("house").alias("kind"), (F.coalesce("m", F.lit(0)) + 1).alias("next_number"))
    paths = rows.select(F.explode("images.image_path").alias("p"))
    image = paths.agg(F.max(F.regexp_extract("p", r"_(\d+)\.", 1).try_cast("long")).alias("m")).select(F.lit("image").alias("kind"), (F.coalesce("m", F.lit(0)) + 1).alias("next_number"))
    return house.unionByName(image)


QUERIES = {f.__name__: f for f in (survey_normalized, survey_complete, code_to_label, code_variants, survey_links, url_checks, ordered_links, parsed_props, canonical_labels, label_changes, anomaly_modes, next_numbers)}


def _cell(c: str) -> str:
    s = f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"
    return f"CASE WHEN lower({s}) NOT IN ('', 'nan', 'none', 'null', '[]', '[ ]') THEN {s} END"


def _card(c: str) -> str:
    s = f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"
    return f"CASE WHEN lower({s}) NOT IN ('', 'nan', 'none', 'null') THEN regexp_replace({s}, '\\.0$', '') END"


def _digits(c: str) -> str:
    return f"CASE WHEN regexp_replace({c}, '\\D', '', 'g') <> '' THEN coalesce(nullif(ltrim(regexp_replace({c}, '\\D', '', 'g'), '0'), ''), '0') END"


# Fixed values, written out for the SQL alone.
_CODE_SQL = {
    "lantai": "WHEN '1' THEN 'marmer/granit' WHEN '2' THEN 'keramik' WHEN '3' THEN 'parket/vinil/karpet' WHEN '4' THEN 'ubin/tegel/teraso' WHEN '5' THEN 'kayu/papan' WHEN '6' THEN 'semen/bata_merah' WHEN '7' THEN 'bambu' WHEN '8' THEN 'tanah' WHEN '9' THEN 'lainnya'",
    "dinding": "WHEN '1' THEN 'tembok' WHEN '2' THEN 'plesteran_anyaman_bambu/kawat' WHEN '3' THEN 'kayu/papan/gypsum/GRC/calciboard' WHEN '4' THEN 'anyaman_bambu' WHEN '5' THEN 'batang_kayu' WHEN '6' THEN 'bambu' WHEN '7' THEN 'lainnya'",
    "atap": "WHEN '1' THEN 'beton' WHEN '2' THEN 'genteng' WHEN '3' THEN 'seng' WHEN '4' THEN 'asbes' WHEN '5' THEN 'bambu' WHEN '6' THEN 'kayu/sirap' WHEN '7' THEN 'jerami/ijuk/daun-daunan/rumbia' WHEN '8' THEN 'lainnya'",
}
_NONE_SQL = "WHEN 'lainnya' THEN 'Lainnya' WHEN 'tidak terdeteksi' THEN 'Tidak terdeteksi' WHEN 'bambu' THEN 'Bambu'"
_CANON_SQL = {
    "atap": _NONE_SQL + " WHEN 'beton' THEN 'Beton' WHEN 'genteng' THEN 'Genteng' WHEN 'seng' THEN 'Seng' WHEN 'asbes' THEN 'Asbes' WHEN 'kayu/sirap' THEN 'Kayu/sirap' WHEN 'kayu sirap' THEN 'Kayu/sirap' WHEN 'jerami/ijuk/daun-daunan/rumbia' THEN 'Jerami/ijuk/daun-daunan/rumbia' WHEN 'jerami/ijuk/daun daunan/rumbia' THEN 'Jerami/ijuk/daun-daunan/rumbia'",
    "dinding": _NONE_SQL + " WHEN 'tembok' THEN 'Tembok' WHEN 'plesteran anyaman bambu/kawat' THEN 'Plesteran anyaman bambu/kawat' WHEN 'kayu/papan/gypsum/grc/calciboard' THEN 'Kayu/papan/gypsum/GRC/calciboard' WHEN 'kayu papan gypsum grc calciboard' THEN 'Kayu/papan/gypsum/GRC/calciboard' WHEN 'anyaman bambu' THEN 'Anyaman bambu' WHEN 'batang kayu' THEN 'Batang kayu'",
    "lantai": _NONE_SQL + " WHEN 'marmer/granit' THEN 'Marmer/granit' WHEN 'keramik' THEN 'Keramik' WHEN 'parket/vinil/karpet' THEN 'Parket/vinil/karpet' WHEN 'ubin/tegel/teraso' THEN 'Ubin/tegel/teraso' WHEN 'kayu/papan' THEN 'Kayu/papan' WHEN 'semen/bata merah' THEN 'Semen/bata merah' WHEN 'tanah' THEN 'Tanah'",
}


def _label(c: str, comp: str) -> str:
    return f"CASE {_digits(c)} {_CODE_SQL[comp]} ELSE 'unclassified' END"


def _canon(c: str, comp: str) -> str:
    s = f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"
    key = f"regexp_replace(replace(lower({s}), '_', ' '), '\\s+', ' ', 'g')"
    return f"CASE WHEN {s} = '' THEN '' WHEN lower({s}) = 'unclassified' THEN 'unclassified' ELSE CASE {key} {_CANON_SQL[comp]} ELSE {s} END END"


_NORMAL = "SELECT survey_id, " + _card("no_kk") + " AS no_kk, " + ", ".join(f"{_cell(c)} AS {c}" for c in ("id_lantai_terluas", "id_dinding_terluas", "id_atap_terluas", "foto_rumah", "foto_rumah_tampak_dalam")) + " FROM survey_rows"
_LINKS = r"""
SELECT survey_id, view, (u.p - 1)::INT AS pos, urls[u.p] AS url FROM (
  SELECT survey_id, view, list_filter(list_transform(str_split(CASE WHEN starts_with(t, '[') AND ends_with(t, ']') AND length(t) >= 2 THEN regexp_replace(substr(t, 2, length(t) - 2), '^\s+|\s+$', '', 'g') ELSE t END, ','),
    lambda p: regexp_replace(regexp_replace(regexp_replace(p, '^\s+|\s+$', '', 'g'), '^''+|''+$', '', 'g'), '^"+|"+$', '', 'g')),
    lambda p: (starts_with(p, 'http://') OR starts_with(p, 'https://')) AND NOT ends_with(p, 'prefix=')) AS urls
  FROM (SELECT survey_id, 'exterior' AS view, regexp_replace(foto_rumah, '^\s+|\s+$', '', 'g') AS t FROM survey_rows
        UNION ALL SELECT survey_id, 'interior', regexp_replace(foto_rumah_tampak_dalam, '^\s+|\s+$', '', 'g') FROM survey_rows)
), unnest(range(1, len(urls) + 1)) AS u(p)"""
_TEXT_URLS = r"SELECT doc_id, (u.p - 1)::INT AS pos, urls[u.p] AS url FROM (SELECT doc_id, regexp_extract_all(text, 'https?://[^\s,\]\[]+') AS urls FROM documents), unnest(range(1, len(urls) + 1)) AS u(p)"


def _any(words: tuple[str, ...]) -> str:
    return "|".join(w.replace(".", r"\.") for w in words)


SQL = {
    "survey_normalized": _NORMAL,
    "survey_complete": f"SELECT survey_id, no_kk, id_lantai_terluas, id_dinding_terluas, id_atap_terluas, foto_rumah FROM ({_NORMAL}) WHERE no_kk IS NOT NULL AND id_lantai_terluas IS NOT NULL AND id_dinding_terluas IS NOT NULL AND id_atap_terluas IS NOT NULL AND foto_rumah IS NOT NULL",
    "code_to_label": "SELECT survey_id, " + ", ".join(f"{_label(f'id_{c}_terluas', c)} AS {c}" for c in COMPONENTS) + " FROM survey_rows",
    "code_variants": f"SELECT survey_id, {_digits('id_lantai_terluas')} AS digits, nullif(CASE WHEN regexp_full_match(regexp_replace(id_lantai_terluas, '^\\s+|\\s+$', '', 'g'), '\\d+\\.0') THEN regexp_replace(regexp_replace(id_lantai_terluas, '^\\s+|\\s+$', '', 'g'), '\\.0$', '') ELSE regexp_replace(id_lantai_terluas, '^\\s+|\\s+$', '', 'g') END, '') AS cell FROM survey_rows",
    "survey_links": _LINKS,
    "url_checks": rf"""
WITH u AS (SELECT url, count(*) AS n FROM (SELECT url FROM ({_LINKS}) UNION ALL SELECT url FROM ({_TEXT_URLS})) GROUP BY 1),
p AS (SELECT url, n, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)), '^www\.', '') AS host, lower(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)) AS path,
  lower(regexp_extract(url, '\?([^#]*)', 1)) AS query, regexp_extract(regexp_extract(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '([^/]*)$', 1), '[^.](\.[^.]+)$', 1) AS suffix FROM u)
SELECT url, n, CASE WHEN NOT starts_with(url, 'http') OR regexp_matches(host, '(^|\.)({_any(BLOCKED_HOSTS)})$') OR path IN ('', '/') OR regexp_matches(path, '{_any(BLOCKED_PARTS)}') OR regexp_matches(path, '({_any(OTHER_ENDS)})$') THEN false
  WHEN regexp_matches(path, '({_any(IMAGE_ENDS)})$') THEN true ELSE regexp_matches(query, 'format=(jpg|jpeg|png|webp|gif|avif)') OR regexp_matches(query, '\.(jpg|jpeg|png|webp|gif|avif)(\b|&|$)') END AS is_image,
  CASE WHEN suffix <> '' THEN suffix ELSE '.jpg' END AS extension FROM p""",
    "ordered_links": f"SELECT url, doc_id AS first_doc, pos AS first_pos FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY doc_id, pos) AS rn FROM ({_TEXT_URLS})) WHERE rn = 1",
    "parsed_props": "SELECT event_type, count(k) AS n, sum(k)::BIGINT AS sum_k, max(k) AS max_k FROM (SELECT event_type, (props->>'$.k')::BIGINT AS k FROM events) GROUP BY 1",
    "canonical_labels": "SELECT annotation_id, " + ", ".join(f"{_canon(f'(fields[{chr(39)}jenis_{c}_terluas{chr(39)}])', c)} AS {c}" for c in COMPONENTS) + " FROM annotations",
    "label_changes": "SELECT field, old, new, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS field, o AS old, {_canon('o', c)} AS new FROM (SELECT fields['jenis_{c}_terluas'] AS o FROM annotations)" for c in COMPONENTS) + ") WHERE old IS DISTINCT FROM new GROUP BY 1, 2, 3",
    "anomaly_modes": r"SELECT annotation_id, " + ", ".join(rf"coalesce(regexp_matches(n, '\banomal[iy][_\s-]?{k}\b'), false) AS flag_{k}" for k in (1, 2, 3, 4)) + r", CASE WHEN regexp_matches(n, '\banomal[iy][_\s-]?1\b') THEN 'swap_slots' WHEN regexp_matches(n, '\banomal[iy][_\s-]?2\b') THEN 'flip_kept_images' ELSE 'normal' END AS mode FROM (SELECT annotation_id, lower(fields['anomaly_notes']) AS n FROM annotations)",
    "next_numbers": r"SELECT 'house' AS kind, coalesce(max(try_cast(regexp_extract(house_id, '(\d+)', 1) AS BIGINT)), 0) + 1 AS next_number FROM sample_15 UNION ALL SELECT 'image', coalesce(max(try_cast(regexp_extract(p, '_(\d+)\.', 1) AS BIGINT)), 0) + 1 FROM (SELECT unnest(images).image_path AS p FROM sample_15)",
}
