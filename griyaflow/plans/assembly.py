"""Queries of near-duplicate removal, chat samples and incremental plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from griyaflow.functions.keys import house_key
from griyaflow.functions.labels import COMPONENTS
from griyaflow.operators import chat as Q
from griyaflow.operators import dedup as D
from griyaflow.plans.base import HOUSES, house_view
from griyaflow.runtime import stored, table

C = F.col
#: The test vectors have no pair at 0.95, the default; at 0.40 they have some.
THRESHOLD = 0.40


def similar_pairs(spark: SparkSession, d: str) -> DataFrame:
    return D.similar_pairs(table(spark, d, "embeddings"), threshold=THRESHOLD).withColumn("score", F.round("score", 6))


def nearest_pairs(spark: SparkSession, d: str) -> DataFrame:
    return D.nearest_pairs(D.similar_pairs(table(spark, d, "embeddings"), threshold=THRESHOLD)).select("a", "b")


def _clusters(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    vectors = table(spark, d, "embeddings")
    house = F.floor(C("vec_id") / 2)
    records = vectors.select(
        C("vec_id").alias("id"), house.alias("house"), _house_type(house).alias("house_type"), F.when(C("label") % 2 == 0, C("label").cast("string")).alias("no_kk"),
        F.when(C("vec_id") % 2 == 0, "exterior").otherwise("interior").alias("view"),
    )
    members = stored(D.clusters(nearest_pairs(spark, d)), "members")
    return records, members, stored(D.winners(members, records, D.retain_order(C("house_type"), C("no_kk"))), "winners")


def _house_type(house: Column) -> Column:
    """The test vectors have no houses: two each, of a type by number."""
    return F.when(house % 4 < 2, "multi").when(house % 4 == 2, "single_interior_only").otherwise("single_exterior_only")


def duplicate_losers(spark: SparkSession, d: str) -> DataFrame:
    _, members, won = _clusters(spark, d)
    return D.losers(members, won)


def duplicate_report(spark: SparkSession, d: str) -> DataFrame:
    """The pairs of each cluster with their likeness."""
    pairs = stored(D.nearest_pairs(D.similar_pairs(table(spark, d, "embeddings"), threshold=THRESHOLD)), "pairs")
    return D.cluster_pairs(pairs, D.clusters(pairs)).withColumn("score", F.round("score", 6))


def duplicate_clusters(spark: SparkSession, d: str) -> DataFrame:
    return _clusters(spark, d)[1]


def duplicate_winners(spark: SparkSession, d: str) -> DataFrame:
    return _clusters(spark, d)[2]


def duplicate_cascade(spark: SparkSession, d: str) -> DataFrame:
    records, members, won = _clusters(spark, d)
    last = table(spark, d, "embeddings").agg((F.floor(F.max("vec_id") / 2) + 1).alias("house"))  # a house that never had a picture
    houses = records.select("house").distinct().unionByName(last).withColumn("house_type", _house_type(C("house")))
    return D.cascade(records, members, won, houses)[1]


def duplicate_stats(spark: SparkSession, d: str) -> DataFrame:
    houses = D.cascade(*_clusters(spark, d))[1]
    out = houses.agg(F.sum("before").alias("images_before"), F.sum("left").alias("images_after"), F.count("*").alias("houses_before"), F.count_if(C("left") > 0).alias("houses_after"))
    return out.withColumn("removed_pct", F.round(F.coalesce(F.try_divide((C("images_before") - C("images_after")) * 100.0, C("images_before")), F.lit(0.0)), 2))


def exact_first(spark: SparkSession, d: str) -> DataFrame:
    return D.first_of_text(table(spark, d, "documents"), "doc_id", "text")


def resume_plan(spark: SparkSession, d: str) -> DataFrame:
    """Documents of houses without an annotation yet; ``cached`` where their model answer is usable."""
    docs = table(spark, d, "documents").select("doc_id", house_key(C("house_id")).alias("house_id"), F.lower(F.trim("source")).alias("source"), "text").filter("house_id is not null")
    done = table(spark, d, "annotations").select(house_key(C("fields")["house_id"]).alias("house_id")).filter("house_id is not null").distinct()
    cached = docs.filter(C("source") == "jawaban_model").filter(Q.usable(C("text"))).select("house_id")
    return Q.pending(docs.select("doc_id", "house_id"), done, cached, "house_id").select("doc_id", "house_id", "plan")


def text_gate(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents")
    return rows.select("doc_id", Q.usable(C("text")).alias("usable"), Q.sections_complete(C("text")).alias("complete"))


def _labelled(spark: SparkSession, d: str) -> tuple[DataFrame, dict, dict]:
    return house_view(spark, d), {c: C(c) for c in COMPONENTS}, {c: F.lit(None).cast("string") for c in COMPONENTS}


def chat_components(spark: SparkSession, d: str) -> DataFrame:
    rows, labels, status = _labelled(spark, d)
    letter = rows.withColumn("letter", Q.schema_letter(C("images")))
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("component"), Q.component(c, C("letter"), labels[c], status[c]).alias("r")) for c in COMPONENTS]))
    return letter.select("rec_id", "letter", each.alias("e")).select("rec_id", "letter", "e.component", "e.r.*")


def chat_table_text(spark: SparkSession, d: str) -> DataFrame:
    rows, labels, status = _labelled(spark, d)
    letter = rows.withColumn("letter", Q.schema_letter(C("images")))
    return letter.select("rec_id", Q.table_text({c: Q.component(c, C("letter"), labels[c], status[c]) for c in COMPONENTS}).alias("answer"))


def chat_samples(spark: SparkSession, d: str) -> DataFrame:
    rows, labels, status = _labelled(spark, d)
    return Q.samples(rows, "Anda menilai bahan bangunan rumah dari foto.", labels, status)


def annotation_tasks(spark: SparkSession, d: str) -> DataFrame:
    rows, labels, _ = _labelled(spark, d)
    return Q.annotation_tasks(rows, labels, C("house_type"))


QUERIES = {f.__name__: f for f in (similar_pairs, nearest_pairs, duplicate_clusters, duplicate_winners, duplicate_losers, duplicate_report, duplicate_cascade, duplicate_stats, exact_first, resume_plan, text_gate, chat_components, chat_table_text, chat_samples, annotation_tasks)}

_PAIRS = f"""WITH RECURSIVE sp AS (SELECT x.vec_id AS a, y.vec_id AS b, list_cosine_similarity(x.embedding::DOUBLE[], y.embedding::DOUBLE[]) AS score FROM embeddings x JOIN embeddings y ON x.vec_id < y.vec_id AND list_cosine_similarity(x.embedding::DOUBLE[], y.embedding::DOUBLE[]) >= {THRESHOLD}),
bo AS (SELECT a, b, score, a AS src, b AS other FROM sp UNION ALL SELECT a, b, score, b, a FROM sp),
np AS (SELECT DISTINCT a, b FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY score DESC, other) AS rn FROM bo) WHERE rn <= 5)"""
_CLUSTERS = _PAIRS + """, ed AS (SELECT a AS u, b AS v FROM np UNION SELECT b, a FROM np), re(u, v) AS (SELECT u, v FROM ed UNION SELECT re.u, ed.v FROM re JOIN ed ON re.v = ed.u),
cl AS (SELECT u AS id, least(u, min(v)) AS cluster FROM re GROUP BY u),
wi AS (SELECT cluster, (list(id ORDER BY CASE WHEN vec_id // 2 % 4 < 2 THEN 0 WHEN vec_id // 2 % 4 = 2 THEN 1 ELSE 2 END, label % 2 <> 0, id))[1] AS winner, count(*) AS size FROM cl JOIN embeddings ON vec_id = id GROUP BY 1),
lo AS (SELECT id FROM cl JOIN wi USING (cluster) WHERE id <> winner),
ho AS (SELECT vec_id // 2 AS house, count(*) AS before, count(*) FILTER (vec_id NOT IN (SELECT id FROM lo)) AS "left" FROM embeddings GROUP BY 1)"""
_USABLE = r"regexp_replace(regexp_replace(coalesce(text, ''), '```[a-z]*', '', 'g'), '^\s+|\s+$', '', 'g')"
_OK = f"({_USABLE} <> '' AND NOT regexp_matches(lower({_USABLE}), 'maaf|sorry|cannot|can.t|tidak bisa membantu|tidak dapat membantu|i can.t|unable|refuse|refusal'))"
_LETTER = HOUSES + ", l AS (SELECT *, CASE house_type WHEN 'multi' THEN 'C' WHEN 'single_exterior_only' THEN 'A' ELSE 'B' END AS letter FROM h)"


def _component(c: str) -> str:
    shown = f"(letter = 'C' OR letter = '{'B' if c == 'lantai' else 'A'}')"
    side = Q.SIDE[c]
    good = f"{shown} AND coalesce({c}, '') <> '' AND lower({c}) <> 'tidak terdeteksi'"
    return f"""SELECT rec_id, letter, '{c}' AS component, CASE WHEN {good} THEN {c} ELSE 'Tidak terdeteksi' END AS label, CASE WHEN {good} THEN 'Tidak sesuai' ELSE 'Tidak teridentifikasi' END AS status, {good} AS needs_text,
CASE WHEN NOT {shown} THEN 'Variabel {c} tidak dapat diidentifikasi karena foto rumah tampak {side} tidak tersedia.' WHEN {good} THEN '' ELSE 'Variabel {c} tidak dapat diidentifikasi karena komponen {c} pada foto rumah tampak {side} tidak terlihat.' END AS reason FROM l"""


_COMPONENTS = _LETTER + ", co AS (" + " UNION ALL ".join(_component(c) for c in COMPONENTS) + ")"
_TASKS = ", ".join(
    ["{'name': 'house_type_valid', 'choice': coalesce(house_type, 'multi')}"]
    + [f"{{'name': '{s}_img_{k}_exists_ctrl', 'choice': CASE WHEN {s}{k} <> '' THEN 'yes' ELSE 'no' END}}" for s in ("ext", "int") for k in (1, 2)]
    + [f"{{'name': 'jenis_{c}_terluas', 'choice': coalesce({c}, 'Belum Diisi')}}" for c in COMPONENTS]
    + [f"CASE WHEN {s}{k} <> '' THEN {{'name': '{s}_img_{k}_status', 'choice': 'KEEP'}} END" for s in ("ext", "int") for k in (1, 2)]
)
_CELLS = ", ".join(f"coalesce(list_filter(images, lambda i: lower(trim(i.view_type)) = '{v}')[{k}].image_path, '') AS {s}{k}" for s, v in (("ext", "exterior"), ("int", "interior")) for k in (1, 2))
SQL = {
    "similar_pairs": _PAIRS + " SELECT a, b, round(score, 6) AS score FROM sp",
    "nearest_pairs": _PAIRS + " SELECT a, b FROM np",
    "duplicate_clusters": _CLUSTERS + " SELECT id, cluster FROM cl",
    "duplicate_winners": _CLUSTERS + " SELECT cluster, winner, size FROM wi",
    "duplicate_cascade": _CLUSTERS + """, hs AS (SELECT DISTINCT vec_id // 2 AS house FROM embeddings UNION SELECT max(vec_id) // 2 + 1 FROM embeddings),
ht AS (SELECT house, CASE WHEN house % 4 < 2 THEN 'multi' WHEN house % 4 = 2 THEN 'single_interior_only' ELSE 'single_exterior_only' END AS house_type FROM hs),
kv AS (SELECT vec_id // 2 AS house, min(CASE WHEN vec_id % 2 = 0 THEN 'exterior' ELSE 'interior' END) AS view FROM embeddings WHERE vec_id NOT IN (SELECT id FROM lo) GROUP BY 1)
SELECT house, house_type, coalesce(before, 0) AS before, coalesce("left", 0) AS "left", CASE WHEN coalesce("left", 0) = 0 THEN NULL WHEN "left" = 1 AND house_type = 'multi' THEN 'single_' || view || '_only' ELSE house_type END AS type_after
FROM ht LEFT JOIN ho USING (house) LEFT JOIN kv USING (house)""",
    "duplicate_losers": _CLUSTERS + " SELECT cluster, winner, id AS loser FROM cl JOIN wi USING (cluster) WHERE id <> winner",
    "duplicate_report": _CLUSTERS + " SELECT cluster, a, b, round(score, 6) AS score FROM np JOIN sp USING (a, b) JOIN cl ON id = a",
    "duplicate_stats": _CLUSTERS + ' SELECT sum(before)::BIGINT AS images_before, sum("left")::BIGINT AS images_after, count(*) AS houses_before, count(*) FILTER ("left" > 0) AS houses_after, round((sum(before) - sum("left")) * 100.0 / sum(before), 2)::DOUBLE AS removed_pct FROM ho',
    "exact_first": "SELECT min(doc_id) AS doc_id FROM documents WHERE text IS NOT NULL GROUP BY text UNION ALL SELECT doc_id FROM documents WHERE text IS NULL",
    "resume_plan": f"WITH dc AS (SELECT doc_id, nullif(upper(trim(house_id)), '') AS house_id, lower(trim(source)) AS source, text FROM documents), ca AS (SELECT DISTINCT house_id FROM dc WHERE source = 'jawaban_model' AND {_OK}) SELECT doc_id, house_id, CASE WHEN house_id IN (SELECT house_id FROM ca WHERE house_id IS NOT NULL) THEN 'cached' ELSE 'pending' END AS plan FROM dc WHERE house_id IS NOT NULL AND house_id NOT IN (SELECT upper(trim(fields['house_id'])) FROM annotations WHERE trim(fields['house_id']) <> '')",
    "text_gate": f"SELECT doc_id, {_OK} AS usable, {_OK} AND length(coalesce(text, '')) >= 80 AND " + " AND ".join(f"contains(coalesce(text, ''), '{s}:')" for s in Q.SECTIONS) + " AS complete FROM documents",
    "chat_components": _COMPONENTS + " SELECT * FROM co",
    "chat_table_text": _COMPONENTS + " SELECT rec_id, 'Hasil[3]{Komponen,Prediksi,Status,Alasan}:' || chr(10) || string_agg(upper(component[1]) || component[2:] || ',' || label || ',' || status || ',\"' || reason || '\"', chr(10) ORDER BY component) AS answer FROM co GROUP BY 1",
    "annotation_tasks": HOUSES + f", t AS (SELECT *, {_CELLS} FROM h), u AS (SELECT rec_id, unnest([{_TASKS}]) AS t FROM t) SELECT rec_id, t.name AS name, t.choice AS choice FROM u WHERE t IS NOT NULL",
}
