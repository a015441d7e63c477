"""Queries of the profiling operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from griyaflow.functions import text as X
from griyaflow.functions.labels import COMPONENTS, LABELS
from griyaflow.operators import profile as P
from griyaflow.plans.base import HOUSES, house_view
from griyaflow.runtime import table

SPLITS = ["train", "val", "test"]
C = F.col


def value_counts(spark: SparkSession, d: str) -> DataFrame:
    return P.value_counts(house_view(spark, d), ["split", "house_type", *COMPONENTS])


def combos_with_null(spark: SparkSession, d: str) -> DataFrame:
    return P.combo_counts(house_view(spark, d), ["house_type", *COMPONENTS])


def combos_without_null(spark: SparkSession, d: str) -> DataFrame:
    return P.combo_counts(house_view(spark, d), ["house_type", *COMPONENTS], keep_null=False)


def pivot_split(spark: SparkSession, d: str) -> DataFrame:
    return P.pivot_counts(house_view(spark, d), ["house_type", "lantai"], "split", SPLITS, "house_id")


def missing_combos(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "sample_15").select(F.lower(F.trim("kelayakan_rumah")).alias("kelayakan"), F.lower(F.trim("split")).alias("split"), "dataset_scheme")
    return P.missing_combos(rows, ["kelayakan", "split", "dataset_scheme"])


def house_key_uniqueness(spark: SparkSession, d: str) -> DataFrame:
    return P.key_uniqueness(house_view(spark, d), "house_id")


def card_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return P.duplicate_keys(table(spark, d, "survey_rows").select(X.clean_card_number(C("no_kk")).alias("no_kk")), "no_kk")


def code_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Valid, missing and out-of-scope codes of survey rows with a picture."""
    rows = table(spark, d, "survey_rows")
    has = (F.size(X.links_of_cell(C("foto_rumah"))) > 0) | (F.size(X.links_of_cell(C("foto_rumah_tampak_dalam"))) > 0)
    fields = {}
    for c in COMPONENTS:
        cell = X.normalize_cell(C(f"id_{c}_terluas"))
        code = X.spreadsheet_code(cell)
        fields[c] = (cell.isNull(), code.isin(*[str(i) for i in range(1, len(LABELS[c]) + 1)]))
    return P.coverage(rows, has, fields)


def image_histogram(spark: SparkSession, d: str) -> DataFrame:
    return house_view(spark, d).groupBy("n_images").agg(F.count("*").alias("n"))


def top_combos(spark: SparkSession, d: str) -> DataFrame:
    """The ten most frequent label combinations: the feature is the limit."""
    counts = P.combo_counts(house_view(spark, d), ["house_type", *COMPONENTS])
    return P.top(counts, 10, [F.desc("n"), *[C(c).asc_nulls_last() for c in ("house_type", *COMPONENTS)]])


def label_by_split(spark: SparkSession, d: str) -> DataFrame:
    return P.distribution_by_split(house_view(spark, d).filter("split is not null"), "split", ["house_type", *COMPONENTS])


def view_by_split(spark: SparkSession, d: str) -> DataFrame:
    rows = house_view(spark, d).filter("split is not null").select("split", F.explode("images").alias("i"))
    return rows.groupBy("split", F.coalesce(F.lower(F.trim("i.view_type")), F.lit("unknown")).alias("view")).agg(F.count("*").alias("n"))


def material_values(spark: SparkSession, d: str) -> DataFrame:
    """Distinct materials per component, in order, a row each."""
    rows = house_view(spark, d)
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("component"), C(c).alias("v")) for c in COMPONENTS]))
    distinct = rows.select(each.alias("e")).select("e.*").filter("v is not null").distinct()
    return distinct.select("component", C("v").alias("value")).orderBy("component", "value")


def region_volume(spark: SparkSession, d: str) -> DataFrame:
    """Star join: revenue and customers per region; dimensions are broadcast where they are small enough."""
    li = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum(F.round(C("l_extendedprice") * (1 - C("l_discount")) * 100).cast("long")).alias("cents"))
    cust = table(spark, d, "customer").join(table(spark, d, "nation"), C("c_nationkey") == C("n_nationkey")).join(table(spark, d, "region"), C("n_regionkey") == C("r_regionkey")).select("c_custkey", "r_name")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return o.join(li, C("o_orderkey") == C("l_orderkey")).join(cust, C("o_custkey") == C("c_custkey")).groupBy("r_name").agg(F.sum("cents").alias("cents"), F.count_distinct("c_custkey").alias("customers"))


QUERIES = {f.__name__: f for f in (value_counts, combos_with_null, combos_without_null, pivot_split, missing_combos, house_key_uniqueness, card_duplicates, code_coverage, image_histogram, top_combos, label_by_split, view_by_split, material_values, region_volume)}

_CARD = r"CASE WHEN lower(regexp_replace(no_kk, '^\s+|\s+$', '', 'g')) NOT IN ('', 'nan', 'none', 'null') THEN regexp_replace(regexp_replace(no_kk, '^\s+|\s+$', '', 'g'), '\.0$', '') END"
_S = r"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def _coverage(c: str) -> str:
    s = _S.format(c=f"id_{c}_terluas")
    codes = ", ".join(f"'{i}'" for i in range(1, len(LABELS[c]) + 1))
    return f"SELECT '{c}' AS field, has, CASE WHEN {s} IS NULL OR lower({s}) IN ('', 'nan', 'none', 'null', '[]', '[ ]') THEN 'missing' WHEN CASE WHEN regexp_full_match({s}, '\\d+\\.0') THEN regexp_replace({s}, '\\.0$', '') ELSE {s} END IN ({codes}) THEN 'valid' ELSE 'out_of_scope' END AS state FROM r"


SQL = {
    "value_counts": HOUSES + " UNION ALL ".join(f"SELECT '{c}' AS field, {c} AS value, count(*) AS n FROM h GROUP BY 2" for c in ("split", "house_type", *COMPONENTS)),
    "combos_with_null": HOUSES + "SELECT house_type, atap, dinding, lantai, count(*) AS n FROM h GROUP BY ALL",
    "combos_without_null": HOUSES + "SELECT house_type, atap, dinding, lantai, count(*) AS n FROM h WHERE house_type IS NOT NULL AND atap IS NOT NULL AND dinding IS NOT NULL AND lantai IS NOT NULL GROUP BY ALL",
    "pivot_split": HOUSES + "SELECT house_type, lantai, " + ", ".join(f"count(CASE WHEN split = '{s}' THEN house_id END) AS {s}" for s in SPLITS) + ", count(CASE WHEN split IN ('train', 'val', 'test') THEN house_id END) AS total FROM h GROUP BY 1, 2",
    "missing_combos": "WITH r AS (SELECT lower(trim(kelayakan_rumah)) AS kelayakan, lower(trim(split)) AS split, dataset_scheme FROM sample_15), p AS (SELECT * FROM (SELECT DISTINCT kelayakan FROM r), (SELECT DISTINCT split FROM r), (SELECT DISTINCT dataset_scheme FROM r)) SELECT * FROM p EXCEPT SELECT kelayakan, split, dataset_scheme FROM r",
    "house_key_uniqueness": HOUSES + ", k AS (SELECT house_id, count(*) AS n FROM h GROUP BY 1) SELECT sum(n)::BIGINT AS total_rows, coalesce(sum(n) FILTER (house_id IS NOT NULL), 0)::BIGINT AS non_null, coalesce(sum(n) FILTER (house_id IS NULL), 0)::BIGINT AS null_rows, count(house_id) AS distinct_keys, count(*) FILTER (house_id IS NOT NULL AND n > 1) AS repeated_keys, coalesce(sum(n) FILTER (house_id IS NOT NULL AND n > 1), 0)::BIGINT AS repeated_rows FROM k",
    "card_duplicates": f"SELECT no_kk, count(*) AS n FROM (SELECT {_CARD} AS no_kk FROM survey_rows) WHERE no_kk IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "code_coverage": r"WITH r AS (SELECT *, (coalesce(regexp_matches(foto_rumah, 'https?://'), false) AND NOT regexp_matches(foto_rumah, 'prefix=')) OR (coalesce(regexp_matches(foto_rumah_tampak_dalam, 'https?://'), false) AND NOT regexp_matches(foto_rumah_tampak_dalam, 'prefix=')) AS has FROM survey_rows), s AS ("
    + " UNION ALL ".join(_coverage(c) for c in COMPONENTS)
    + ") SELECT field, count(*) AS all_rows, count(*) FILTER (has) AS image_rows, count(*) FILTER (has AND state = 'valid') AS valid, count(*) FILTER (has AND state = 'missing') AS missing, count(*) FILTER (has AND state = 'out_of_scope') AS out_of_scope, round(coalesce(count(*) FILTER (has AND state = 'valid') * 100.0 / nullif(count(*), 0), 0)::DOUBLE, 2) AS valid_pct_all, round(coalesce(count(*) FILTER (has AND state = 'valid') * 100.0 / nullif(count(*) FILTER (has), 0), 0)::DOUBLE, 2) AS valid_pct_image FROM s GROUP BY 1",
    "image_histogram": HOUSES + "SELECT n_images, count(*) AS n FROM h GROUP BY 1",
    "top_combos": HOUSES + "SELECT house_type, atap, dinding, lantai, count(*) AS n FROM h GROUP BY ALL ORDER BY n DESC, house_type NULLS LAST, atap NULLS LAST, dinding NULLS LAST, lantai NULLS LAST LIMIT 10",
    "label_by_split": HOUSES + " UNION ALL ".join(f"SELECT split, '{c}' AS field, {c} AS value, count(*) AS n FROM h WHERE split IS NOT NULL AND {c} IS NOT NULL GROUP BY 1, 3" for c in ("house_type", *COMPONENTS)),
    "view_by_split": HOUSES + "SELECT split, coalesce(lower(trim(i.view_type)), 'unknown') AS view, count(*) AS n FROM (SELECT split, unnest(images) AS i FROM h WHERE split IS NOT NULL) GROUP BY 1, 2",
    "material_values": HOUSES + "SELECT DISTINCT component, v AS value FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS component, {c} AS v FROM h" for c in COMPONENTS) + ") WHERE v IS NOT NULL",
    "region_volume": "SELECT r_name, sum(cents)::BIGINT AS cents, count(DISTINCT c_custkey) AS customers FROM orders JOIN (SELECT l_orderkey, sum(round(l_extendedprice * (1 - l_discount) * 100)::BIGINT) AS cents FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1",
}
