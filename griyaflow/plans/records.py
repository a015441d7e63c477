"""Queries of keyed record sets, annotations and the nested house model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from griyaflow.functions import text as X
from griyaflow.functions.keys import choice, house_key, path_key
from griyaflow.functions.labels import COMPONENTS
from griyaflow.operators import houses as H
from griyaflow.operators import keyed as K
from griyaflow.operators import reconcile as R
from griyaflow.operators.ranking import best_per_key, global_rank
from griyaflow.plans.base import HOUSES, STRATUM, house_view
from griyaflow.runtime import table

C = F.col


def first_per_house(spark: SparkSession, d: str) -> DataFrame:
    rows = house_view(spark, d).filter("house_id is not null")
    return best_per_key(rows.select("house_id", "rec_id", "house_type"), ["house_id"], C("rec_id"))


def latest_per_house(spark: SparkSession, d: str) -> DataFrame:
    rows = house_view(spark, d).filter("house_id is not null")
    return best_per_key(rows.select("house_id", "rec_id", "house_type", "captured_at"), ["house_id"], F.struct("captured_at", "rec_id"), last=True).drop("captured_at")


def latest_event(spark: SparkSession, d: str) -> DataFrame:
    return best_per_key(table(spark, d, "events"), ["user_id"], F.struct("ts", "event_id"), last=True).select("user_id", "event_id", "event_type")


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    out = []
    for name, rid in (("sample_15", "rec_id"), ("sample_mirror", "mirror_id")):
        out.append(table(spark, d, name).select(house_key(C("house_id")).alias("house_id"), C(rid).alias("id"), choice(C("kelayakan_rumah")).alias("kelayakan")))
    return out[0], out[1]


def upserted(spark: SparkSession, d: str) -> DataFrame:
    base, changed = _sides(spark, d)
    return K.upsert(base, changed, "house_id", "id")


def merged_first_wins(spark: SparkSession, d: str) -> DataFrame:
    return K.merge_first_wins(list(_sides(spark, d)), "house_id", "id").select("house_id", "id", "kelayakan", "source_no")


def _latest_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    out = []
    for name, rid in (("sample_15", "rec_id"), ("sample_mirror", "mirror_id")):
        rows = H.houses(table(spark, d, name).withColumnRenamed(rid, "rec_id")).filter("house_id is not null")
        out.append(best_per_key(rows.drop("split"), ["house_id"], F.struct("captured_at", "rec_id"), last=True))
    return out[0], out[1]


def record_changes(spark: SparkSession, d: str) -> DataFrame:
    """Text of what changed per house between the two copies."""
    a, b = _latest_sides(spark, d)
    views = lambda t, n: t.select("house_id", F.explode("images").alias("i")).select("house_id", path_key(C("i.image_path")).alias("path"), F.lower(F.trim("i.view_type")).alias(n)).filter("path is not null").groupBy("house_id", "path").agg(F.max(n).alias(n))
    moved = views(a, "v1").join(views(b, "v2"), ["house_id", "path"]).filter("not (v1 <=> v2)")
    line = F.concat("path", F.lit(": "), F.coalesce("v1", F.lit("None")), F.lit(" -> "), F.coalesce("v2", F.lit("None")))
    moved = moved.groupBy("house_id").agg(F.array_join(F.array_sort(F.collect_list(line)), "; ").alias("moved"))
    left = a.select("house_id", *[C(c).alias(f"a_{c}") for c in ("house_type", "n_images", *COMPONENTS)], F.lit(True).alias("in_a"))
    right = b.select("house_id", *[C(c).alias(f"b_{c}") for c in ("house_type", "n_images", *COMPONENTS)], F.lit(True).alias("in_b"))
    both = left.join(right, "house_id", "full_outer").join(moved, "house_id", "left")
    fields = {n: (C(f"a_{c}"), C(f"b_{c}")) for n, c in (("house_type", "house_type"), ("image_count", "n_images"))}
    extra = [F.when(C("moved").isNotNull(), F.concat(F.lit("view_type_changed: "), C("moved")))]
    text = K.change_text(fields, [*extra, *[F.when(~C(f"a_{c}").eqNullSafe(C(f"b_{c}")), F.concat(F.lit(f"{c}: "), F.coalesce(f"a_{c}", F.lit("None")), F.lit(" -> "), F.coalesce(f"b_{c}", F.lit("None")))) for c in COMPONENTS]])
    change = F.when(C("in_b").isNull(), "missing_in_final_file").when(C("in_a").isNull(), "missing_in_base_file").otherwise(text)
    return both.select("house_id", change.alias("change")).filter("change <> ''")


def statuses(spark: SparkSession, d: str) -> DataFrame:
    """Agreement of both copies' labels per component."""
    a, b = _latest_sides(spark, d)
    both = a.select("house_id", *[C(c).alias(f"a_{c}") for c in COMPONENTS]).join(b.select("house_id", *[C(c).alias(f"b_{c}") for c in COMPONENTS]), "house_id")
    return both.select("house_id", *[X.comparison_status(C(f"a_{c}"), C(f"b_{c}")).alias(c) for c in COMPONENTS])


def status_tally(spark: SparkSession, d: str) -> DataFrame:
    each = F.explode(F.array(*[C(c) for c in COMPONENTS]))
    return statuses(spark, d).select(each.alias("status")).groupBy("status").agg(F.count("*").alias("n"))


def synthetic_reference(spark: SparkSession, d: str) -> DataFrame:
    """Reference labels drawn by hash: seven in ten agree, the rest is another label of the list."""
    from griyaflow.functions.labels import ROOF_DRAW as labels

    u = lambda salt: F.conv(F.substring(F.md5(F.concat(F.lit(f"{salt}|"), C("rec_id").cast("string"))), 1, 8), 16, 10).cast("long")
    own = F.coalesce("atap", F.lit("none"))
    others = F.filter(F.array(*[F.lit(x) for x in labels]), lambda x: x != own)
    drawn = F.get(others, (u("other") % F.size(others)).cast("int"))
    return house_view(spark, d).select("rec_id", F.when(C("atap").isNotNull() & (u("same") % 10 < 7), C("atap")).otherwise(drawn).alias("reference"))


def applied_to_changed(spark: SparkSession, d: str) -> DataFrame:
    """Houses that a later annotation touches get its roof label; all others pass through."""
    rows = house_view(spark, d).filter("house_id is not null").select("house_id", "rec_id", "atap")
    ids = R.latest_annotations(table(spark, d, "annotations")).select("house_id")
    return K.apply_to_changed(rows, ids, "house_id", {"atap": F.concat(F.lit("checked:"), F.coalesce("atap", F.lit("")))})


def _annotated(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    latest = R.latest_annotations(table(spark, d, "annotations"))
    rows = house_view(spark, d).filter("house_id is not null")
    sources = best_per_key(rows, ["house_id"], C("rec_id"), last=True)
    return latest, sources, R.kept_images(R.annotation_slots(latest), sources.select("house_id", "images"))


def annotation_slots(spark: SparkSession, d: str) -> DataFrame:
    return R.annotation_slots(R.latest_annotations(table(spark, d, "annotations")))


def kept_images(spark: SparkSession, d: str) -> DataFrame:
    return _annotated(spark, d)[2]


def enriched_pass_through(spark: SparkSession, d: str) -> DataFrame:
    latest, sources, kept = _annotated(spark, d)
    return R.enrich(sources, latest, kept).select("house_id", "rec_id", "state", "n_kept")


def enriched_inner(spark: SparkSession, d: str) -> DataFrame:
    latest, sources, kept = _annotated(spark, d)
    return R.enrich(sources, latest, kept, inner=True).select("house_id", "rec_id", "annotation_id", "n_kept")


def reconciled_labels(spark: SparkSession, d: str) -> DataFrame:
    latest, sources, kept = _annotated(spark, d)
    return R.reconciled_labels(R.enrich(sources, latest, kept, inner=True)).select("house_id", "house_type", *[f"final_{c}" for c in COMPONENTS])


def inferred_types(spark: SparkSession, d: str) -> DataFrame:
    """The four fallbacks of a type when no picture tells it."""
    i = C("images")
    raw = F.when(F.lower(F.trim("dataset_scheme")) == "multi", "multi").otherwise("single_exterior_only")
    return table(spark, d, "sample_15").select("rec_id", H.house_type(i, raw).alias("augmented"), H.house_type(i, F.lit("")).alias("reconciled"), H.house_type(i, F.lit("multi")).alias("annotated"), H.house_type(i, F.lit("single")).alias("ingested"))


def picture_by_view(spark: SparkSession, d: str) -> DataFrame:
    i = C("images")
    return table(spark, d, "sample_15").select("rec_id", H.first_of_view(i, "exterior")["image_path"].alias("first_exterior"), H.last_of_view(i, "exterior")["image_path"].alias("last_exterior"), H.first_of_view(i, "interior")["image_path"].alias("first_interior"), H.last_of_view(i, "interior")["image_path"].alias("last_interior"))


def slot_pivot(spark: SparkSession, d: str) -> DataFrame:
    cols = H.slots(C("images"))
    return table(spark, d, "sample_15").select("rec_id", *[c.alias(n) for n, c in cols], *[F.when(c != "", "yes").otherwise("no").alias(f"{n}_exists") for n, c in cols])


def fan_out_views(spark: SparkSession, d: str) -> DataFrame:
    return H.fan_out(house_view(spark, d).filter("house_type = 'multi' and house_id is not null"))


def running_ids(spark: SparkSession, d: str) -> DataFrame:
    """Minted ids over survey rows with a card number: H and a running number by survey id."""
    rows = table(spark, d, "survey_rows").select("survey_id", X.clean_card_number(C("no_kk")).alias("no_kk")).dropna("any")
    return global_rank(rows, ["survey_id"]).select("survey_id", F.format_string("H%05d", "rank").alias("minted"))


def running_image_ids(spark: SparkSession, d: str) -> DataFrame:
    """Picture ids over all survey links, exterior before interior within a row."""
    from griyaflow.plans.cells import survey_links

    return global_rank(survey_links(spark, d), ["survey_id", "view", "pos"]).select("survey_id", "view", "pos", F.format_string("IMG%06d", "rank").alias("image_id"))


def strata_texts(spark: SparkSession, d: str) -> DataFrame:
    return house_view(spark, d).select("rec_id", H.stratum().alias("stratum"))


QUERIES = {
    f.__name__: f
    for f in (
        first_per_house, latest_per_house, latest_event, upserted, merged_first_wins, record_changes, statuses, status_tally, synthetic_reference, applied_to_changed, annotation_slots, kept_images,
        enriched_pass_through, enriched_inner, reconciled_labels, inferred_types, picture_by_view, slot_pivot, fan_out_views, running_ids, running_image_ids, strata_texts,
    )
}

_KEL = "nullif(regexp_replace(lower(trim(kelayakan_rumah)), '[ _-]+', '_', 'g'), '')"
_TWO = f"""WITH a AS (SELECT nullif(upper(trim(house_id)), '') AS house_id, rec_id AS id, {_KEL} AS kelayakan FROM sample_15),
b AS (SELECT nullif(upper(trim(house_id)), '') AS house_id, mirror_id AS id, {_KEL} AS kelayakan FROM sample_mirror)"""
_H2 = HOUSES.replace("WITH h AS", "h2 AS").replace("SELECT rec_id,", "SELECT mirror_id AS rec_id,").replace("FROM sample_15", "FROM sample_mirror")
_LATEST = HOUSES + "," + _H2 + """,
la AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY house_id ORDER BY captured_at DESC NULLS LAST, rec_id DESC) AS rn FROM h WHERE house_id IS NOT NULL) WHERE rn = 1),
lb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY house_id ORDER BY captured_at DESC NULLS LAST, rec_id DESC) AS rn FROM h2 WHERE house_id IS NOT NULL) WHERE rn = 1)"""


def _status(c: str) -> str:
    det = lambda x: f"CASE WHEN lower({x}) = 'tidak terdeteksi' THEN 'Tidak terdeteksi' WHEN {x} <> '' THEN {x} END"
    return f"CASE WHEN coalesce({det(f'la.{c}')}, 'Tidak terdeteksi') = 'Tidak terdeteksi' OR coalesce({det(f'lb.{c}')}, 'Tidak terdeteksi') = 'Tidak terdeteksi' THEN 'Tidak teridentifikasi' WHEN la.{c} = lb.{c} THEN 'Sesuai' ELSE 'Tidak sesuai' END AS {c}"


_STATUSES = _LATEST + ", st AS (SELECT la.house_id, " + ", ".join(_status(c) for c in COMPONENTS) + " FROM la JOIN lb USING (house_id))"
_DIFF = lambda name, x, y: f"CASE WHEN {x} IS DISTINCT FROM {y} THEN '{name}: ' || coalesce({x}::VARCHAR, 'None') || ' -> ' || coalesce({y}::VARCHAR, 'None') END"
_VIEWS = "SELECT house_id, path, max(v) AS v FROM (SELECT house_id, replace(lower(trim(i.image_path)), '\\', '/') AS path, lower(trim(i.view_type)) AS v FROM (SELECT house_id, unnest(images) AS i FROM {t})) WHERE path <> '' GROUP BY 1, 2"
_ANN = r"""
WITH an AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY house_id ORDER BY annotated_at DESC NULLS LAST, annotation_id DESC) AS rn FROM (SELECT *, nullif(upper(trim(fields['house_id'])), '') AS house_id FROM annotations) WHERE house_id IS NOT NULL) WHERE rn = 1),
md AS (SELECT annotation_id, house_id, CASE WHEN regexp_matches(lower(fields['anomaly_notes']), '\banomal[iy][_\s-]?1\b') THEN 'swap_slots' WHEN regexp_matches(lower(fields['anomaly_notes']), '\banomal[iy][_\s-]?2\b') THEN 'flip_kept_images' ELSE 'normal' END AS mode, unnest(map_entries(fields)) AS en FROM an),
nm AS (SELECT annotation_id, house_id, mode, regexp_extract(lower(en.key), '^(ext|int)_img_', 1) AS side, regexp_extract(lower(en.key), '_img_(\d+)', 1)::INT AS slot, coalesce(nullif(regexp_extract(lower(en.key), '_(db|id|exists|status)$', 1), ''), 'db') AS f, en.value AS v FROM md WHERE regexp_matches(lower(en.key), '^(ext|int)_img_(\d+)(?:_(db|id|exists|status))?$')),
gs AS (SELECT annotation_id, house_id, mode, side, slot, nullif(trim(max(v) FILTER (f = 'db')), '') AS link, nullif(trim(max(v) FILTER (f = 'id')), '') AS image_id, max(v) FILTER (f = 'exists') AS ex, max(v) FILTER (f = 'status') AS st FROM nm GROUP BY 1, 2, 3, 4, 5),
sl AS (SELECT annotation_id, house_id, mode, side, slot, link, image_id, CASE WHEN ex IS NULL THEN link IS NOT NULL OR image_id IS NOT NULL ELSE lower(regexp_replace(ex, '^\s+|\s+$', '', 'g')) = 'yes' END AS there,
  coalesce(upper(regexp_replace(st, '^\s+|\s+$', '', 'g')) = 'KEEP', true) AS kept, CASE WHEN (side = 'ext') = (mode = 'normal') THEN 'exterior' ELSE 'interior' END AS view_type FROM gs)"""
_KEPT = _ANN + "," + HOUSES.replace("WITH h AS", "h AS") + r""",
so AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY house_id ORDER BY rec_id DESC) AS rn FROM h WHERE house_id IS NOT NULL) WHERE rn = 1),
pi AS (SELECT house_id, u.p - 1 AS pos, replace(lower(trim(images[u.p].image_path)), '\', '/') AS path FROM so, unnest(range(1, len(images) + 1)) AS u(p)),
pn AS (SELECT *, try_cast(regexp_extract(path, '_(\d+)\.', 1) AS BIGINT) AS number FROM pi WHERE path <> ''),
bl AS (SELECT house_id, path, max(pos) AS link_pos FROM pn GROUP BY 1, 2), bi AS (SELECT house_id, number, max(pos) AS id_pos FROM pn WHERE number IS NOT NULL GROUP BY 1, 2),
ks AS (SELECT sl.annotation_id, sl.house_id, side, slot, view_type, CASE WHEN link_pos IS NOT NULL THEN 'link' WHEN id_pos IS NOT NULL THEN 'id' ELSE 'default' END AS found_by, coalesce(link_pos, id_pos)::INT AS source_pos
  FROM sl LEFT JOIN bl ON bl.house_id = sl.house_id AND bl.path = lower(regexp_extract(sl.link, '^https?://[^/]+/(.*)$', 1)) LEFT JOIN bi ON bi.house_id = sl.house_id AND bi.number = try_cast(regexp_extract(sl.image_id, '(\d+)', 1) AS BIGINT) WHERE there AND kept),
nk AS (SELECT annotation_id, count(*) AS n FROM ks GROUP BY 1),
er AS (SELECT so.*, an.annotation_id, CASE WHEN an.annotation_id IS NOT NULL THEN coalesce(n, 0) END AS n_kept, an.fields FROM so LEFT JOIN an USING (house_id) LEFT JOIN nk ON nk.annotation_id = an.annotation_id)"""


def _final(c: str, shown_by: tuple[str, ...]) -> str:
    det = lambda x: f"CASE WHEN lower(regexp_replace({x}, '^\\s+|\\s+$', '', 'g')) = 'tidak terdeteksi' THEN 'Tidak terdeteksi' ELSE nullif(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'), '') END"
    annotated = f"(fields['jenis_{c}_terluas'])"
    return f"CASE WHEN house_type IN ({', '.join(repr(k) for k in shown_by)}) THEN 'Tidak terdeteksi' ELSE coalesce({det(annotated)}, {det(c)}) END AS final_{c}"


def _view(which: str, view: str) -> str:
    lst = f"list_filter(images, lambda i: lower(trim(i.view_type)) = '{view}')"
    return f"{lst}[{1 if which == 'first' else -1}].image_path AS {which}_{view}"


def _slot_sql() -> str:
    cols = []
    for short, view in (("ext", "exterior"), ("int", "interior")):
        for k in (1, 2):
            cell = f"coalesce(list_filter(images, lambda i: lower(trim(i.view_type)) = '{view}')[{k}].image_path, '')"
            cols += [f"{cell} AS {short}_img_{k}", f"CASE WHEN {cell} <> '' THEN 'yes' ELSE 'no' END AS {short}_img_{k}_exists"]
    return "SELECT rec_id, " + ", ".join(cols) + " FROM sample_15"


_TYPE = HOUSES + "SELECT h.rec_id, " + ", ".join(f"coalesce(house_type, {e}) AS {n}" for n, e in (("augmented", "CASE WHEN lower(trim(s.dataset_scheme)) = 'multi' THEN 'multi' ELSE 'single_exterior_only' END"), ("reconciled", "''"), ("annotated", "'multi'"), ("ingested", "'single'"))) + " FROM h JOIN sample_15 s USING (rec_id)"


def _sql() -> dict[str, str]:
    from griyaflow.functions.labels import ROOF_DRAW
    from griyaflow.plans import cells

    labels = "[" + ", ".join(f"'{x}'" for x in ROOF_DRAW) + "]"
    u = lambda salt: f"('0x' || substr(md5('{salt}|' || rec_id), 1, 8))::BIGINT"
    others = f"list_filter({labels}, lambda x: x <> coalesce(atap, 'none'))"
    return {
        "first_per_house": HOUSES + "SELECT house_id, min(rec_id) AS rec_id, (list(house_type ORDER BY rec_id))[1] AS house_type FROM h WHERE house_id IS NOT NULL GROUP BY 1",
        "latest_per_house": _LATEST + " SELECT house_id, rec_id, house_type FROM la",
        "latest_event": "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1",
        "upserted": _TWO + ", l AS (SELECT house_id, max(id) AS id, arg_max(struct_pack(k := kelayakan), id) AS r FROM b WHERE house_id IS NOT NULL GROUP BY 1) SELECT a.house_id, CASE WHEN l.house_id IS NULL THEN a.id ELSE l.id END AS id, CASE WHEN l.house_id IS NULL THEN a.kelayakan ELSE l.r.k END AS kelayakan, CASE WHEN l.house_id IS NULL THEN 'base' ELSE 'replaced' END AS origin FROM a LEFT JOIN l USING (house_id) UNION ALL SELECT house_id, id, kelayakan, 'appended' FROM b WHERE house_id IS NOT NULL AND house_id NOT IN (SELECT house_id FROM a WHERE house_id IS NOT NULL)",
        "merged_first_wins": _TWO + ", t AS (SELECT *, 0 AS source_no FROM a UNION ALL SELECT *, 1 FROM b) SELECT house_id, id, kelayakan, source_no FROM (SELECT *, row_number() OVER (PARTITION BY house_id ORDER BY source_no, id) AS rn FROM t) WHERE rn = 1 OR house_id IS NULL",
        "record_changes": _LATEST + f", va AS ({_VIEWS.format(t='la')}), vb AS ({_VIEWS.format(t='lb')}), mv AS (SELECT va.house_id, string_agg(path || ': ' || coalesce(va.v, 'None') || ' -> ' || coalesce(vb.v, 'None'), '; ' ORDER BY path || ': ' || coalesce(va.v, 'None') || ' -> ' || coalesce(vb.v, 'None')) AS moved FROM va JOIN vb USING (house_id, path) WHERE va.v IS DISTINCT FROM vb.v GROUP BY 1), "
        + "ch AS (SELECT coalesce(la.house_id, lb.house_id) AS house_id, CASE WHEN lb.house_id IS NULL THEN 'missing_in_final_file' WHEN la.house_id IS NULL THEN 'missing_in_base_file' ELSE concat_ws(' | ', "
        + ", ".join([_DIFF("house_type", "la.house_type", "lb.house_type"), _DIFF("image_count", "la.n_images", "lb.n_images"), "'view_type_changed: ' || moved", *[_DIFF(c, f"la.{c}", f"lb.{c}") for c in COMPONENTS]])
        + ") END AS change FROM la FULL JOIN lb ON la.house_id = lb.house_id LEFT JOIN mv ON mv.house_id = la.house_id) SELECT * FROM ch WHERE change <> ''",
        "statuses": _STATUSES + " SELECT * FROM st",
        "status_tally": _STATUSES + " SELECT status, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT {c} AS status FROM st" for c in COMPONENTS) + ") GROUP BY 1",
        "synthetic_reference": HOUSES + f"SELECT rec_id, CASE WHEN atap IS NOT NULL AND {u('same')} % 10 < 7 THEN atap ELSE {others}[1 + ({u('other')} % len({others}))::INT] END AS reference FROM h",
        "applied_to_changed": HOUSES + ", i AS (SELECT DISTINCT nullif(upper(trim(fields['house_id'])), '') AS house_id FROM annotations) SELECT house_id, rec_id, CASE WHEN house_id IN (SELECT house_id FROM i WHERE house_id IS NOT NULL) THEN 'checked:' || coalesce(atap, '') ELSE atap END AS atap, house_id IN (SELECT house_id FROM i WHERE house_id IS NOT NULL) AS changed FROM h WHERE house_id IS NOT NULL",
        "annotation_slots": _ANN + " SELECT * FROM sl",
        "kept_images": _KEPT + " SELECT * FROM ks",
        "enriched_pass_through": _KEPT + " SELECT house_id, rec_id, CASE WHEN annotation_id IS NULL THEN 'passed' ELSE 'rebuilt' END AS state, n_kept FROM er WHERE annotation_id IS NULL OR n_kept > 0",
        "enriched_inner": _KEPT + " SELECT house_id, rec_id, annotation_id, n_kept FROM er WHERE n_kept > 0",
        "reconciled_labels": _KEPT + " SELECT house_id, house_type, " + ", ".join([_final("atap", ("single_interior_only",)), _final("dinding", ("single_interior_only",)), _final("lantai", ("single_exterior_only",))]) + " FROM er WHERE n_kept > 0",
        "inferred_types": _TYPE,
        "picture_by_view": "SELECT rec_id, " + ", ".join(_view(w, v) for v in ("exterior", "interior") for w in ("first", "last")) + " FROM sample_15",
        "slot_pivot": _slot_sql(),
        "fan_out_views": HOUSES + " UNION ALL ".join(f"SELECT rec_id, house_id || '{tag}' AS house_id, 'single_{v}_only' AS house_type, list_filter(images, lambda i: lower(trim(i.view_type)) = '{v}')[1].image_path AS image_path FROM h WHERE house_type = 'multi' AND house_id IS NOT NULL" for v, tag in (("exterior", "_EXT"), ("interior", "_INT"))),
        "running_ids": "SELECT survey_id, printf('H%05d', row_number() OVER (ORDER BY survey_id)) AS minted FROM (" + cells._NORMAL + ") WHERE no_kk IS NOT NULL",
        "running_image_ids": "SELECT survey_id, view, pos, printf('IMG%06d', row_number() OVER (ORDER BY survey_id, view, pos)) AS image_id FROM (" + cells._LINKS + ")",
        "strata_texts": HOUSES + f"SELECT rec_id, {STRATUM} AS stratum FROM h",
    }


SQL = _sql()
