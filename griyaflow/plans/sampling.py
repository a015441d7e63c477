"""Queries of the samples, splits, shards and caps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from griyaflow.functions.keys import non_empty
from griyaflow.operators import sampling as S
from griyaflow.operators.houses import stratum
from griyaflow.plans.base import HOUSES, STRATUM, house_view
from griyaflow.runtime import table

C = F.col


def _units(spark: SparkSession, d: str) -> DataFrame:
    rows = house_view(spark, d)
    return S.split_units(rows, "house_id", "rec_id", "house_type", stratum()).filter("kind is not null").withColumn("stratum", F.coalesce("stratum", F.concat("kind", F.lit("||none"))))


def split_units(spark: SparkSession, d: str) -> DataFrame:
    """All rows of a house get one split, strata in proportion."""
    return S.stratified_split(_units(spark, d), "unit", "stratum").select("unit", "stratum", "new_split")


def split_summary(spark: SparkSession, d: str) -> DataFrame:
    return split_units(spark, d).groupBy("new_split", F.split("stratum", r"\|\|")[0].alias("house_type")).agg(F.count("*").alias("units"))


def split_sizes(spark: SparkSession, d: str) -> DataFrame:
    n = _units(spark, d).groupBy("stratum").agg(F.count("*").alias("n"))
    return n.select("stratum", "n", *[c.alias(k) for k, c in S.desired_split_sizes(C("n")).items()])


def _multi(spark: SparkSession, d: str) -> DataFrame:
    return house_view(spark, d).filter("house_type = 'multi'").select("rec_id", F.coalesce("dinding", F.lit("unknown")).alias("stratum"))


def sample_proportional(spark: SparkSession, d: str) -> DataFrame:
    """300 houses with both views, walls in proportion."""
    return S.proportional_sample(_multi(spark, d), "stratum", "rec_id", 300).filter("in_sample").select("rec_id", "stratum")


def sample_remainder(spark: SparkSession, d: str) -> DataFrame:
    """Two stages: 300 drawn, 200 of them kept, the other 100 returned."""
    drawn = S.proportional_sample(_multi(spark, d), "stratum", "rec_id", 300).filter("in_sample").drop("in_sample")
    return S.proportional_sample(drawn, "stratum", "rec_id", 200, seed="43").filter("not in_sample").select("rec_id", "stratum")


def sample_unique_groups(spark: SparkSession, d: str) -> DataFrame:
    """150 source groups that no test row uses, one record each, by type."""
    rows = table(spark, d, "sample_15").select("rec_id", non_empty(F.lower(F.trim("source_group_id"))).alias("grp"), F.coalesce("dataset_scheme", F.lit("unknown")).alias("stratum"), F.lower(F.trim("split")).alias("s"))
    used = rows.filter("s = 'test' and grp is not null").select("grp").distinct()
    return S.unique_sample(rows.select("rec_id", "grp", "stratum"), "grp", "rec_id", "stratum", used, 150).select("rec_id", "grp", "stratum")


def annotator_shards(spark: SparkSession, d: str) -> DataFrame:
    rows = house_view(spark, d).select("rec_id", F.coalesce("house_type", F.lit("unknown")).alias("kind"))
    return S.shards(rows, "kind", "rec_id", "rec_id", 8).select("rec_id", "kind", "shard")


def cap_single(spark: SparkSession, d: str) -> DataFrame:
    """At most 60 records per roof material, first come."""
    rows = house_view(spark, d).select("rec_id", F.array_compact(F.array("atap")).alias("labels"))
    return S.label_cap(rows, "rec_id", "rec_id", "labels", 60).select("rec_id")


def cap_multi(spark: SparkSession, d: str) -> DataFrame:
    """At most 60 per label of any component, each house once."""
    labels = F.array_compact(F.array(*[F.concat(F.lit(f"{c}="), C(c)) for c in ("atap", "dinding", "lantai")]))
    rows = house_view(spark, d).select("rec_id", "house_id", labels.alias("labels"))
    return S.label_cap(rows, "house_id", "rec_id", "labels", 60).select("rec_id", "house_id")


QUERIES = {f.__name__: f for f in (split_units, split_summary, split_sizes, sample_proportional, sample_remainder, sample_unique_groups, annotator_shards, cap_single, cap_multi)}

_UNITS = (
    HOUSES
    + f""", r AS (SELECT *, coalesce(house_id, '__row_' || rec_id || '__') AS unit, {STRATUM} AS s FROM h),
u AS (SELECT unit, arg_min(house_type, rec_id) FILTER (house_type IS NOT NULL) AS kind, (list(s ORDER BY rec_id))[1] AS s FROM r GROUP BY 1),
q AS (SELECT unit, coalesce(s, kind || '||none') AS stratum FROM u WHERE kind IS NOT NULL)"""
)
_SIZES = """, n AS (SELECT stratum, count(*) AS n FROM q GROUP BY 1),
z AS (SELECT stratum, n, (n * 8 - n * 8 % 10) // 10 AS t0, n // 10 AS s0, n - (n * 8) // 10 - 2 * (n // 10) AS rest, (n * 8) % 10 >= n % 10 AS tf FROM n),
y AS (SELECT stratum, n, t0 + CASE WHEN tf AND rest >= 1 THEN 1 ELSE 0 END AS t, s0 + CASE WHEN CASE WHEN tf THEN 2 ELSE 1 END <= rest THEN 1 ELSE 0 END AS v, s0 + CASE WHEN CASE WHEN tf THEN 3 ELSE 2 END <= rest THEN 1 ELSE 0 END AS s FROM z),
w AS (SELECT stratum, n, CASE WHEN n <= 3 THEN 1 ELSE t - (CASE WHEN v = 0 THEN 1 ELSE 0 END) - (CASE WHEN s = 0 THEN 1 ELSE 0 END) END::BIGINT AS train,
  CASE n WHEN 1 THEN 0 WHEN 2 THEN 0 ELSE greatest(v, 1) END::BIGINT AS val, CASE n WHEN 1 THEN 0 ELSE greatest(s, 1) END::BIGINT AS test FROM y)"""
_SPLIT = _UNITS + _SIZES + """, k AS (SELECT q.unit, q.stratum, w.train, w.val, row_number() OVER (PARTITION BY q.stratum ORDER BY md5('42|' || q.unit), q.unit) AS rn FROM q JOIN w USING (stratum)),
f AS (SELECT unit, stratum, CASE WHEN rn <= train THEN 'train' WHEN rn <= train + val THEN 'val' ELSE 'test' END AS new_split FROM k)"""


def _sample(source: str, name: str, key: str, target: int, seed: str, cap: bool = True) -> str:
    quota = "least(base + CASE WHEN place <= lft THEN 1 ELSE 0 END, n)" if cap else "base + CASE WHEN place <= lft THEN 1 ELSE 0 END"
    return f""", {name}_n AS (SELECT stratum, count(*) AS n FROM {source} GROUP BY 1),
{name}_a AS (SELECT stratum, n, (n * {target}) // sum(n) OVER () AS base, (n * {target}) % sum(n) OVER () AS frac FROM {name}_n),
{name}_b AS (SELECT *, {target} - sum(base) OVER () AS lft, row_number() OVER (ORDER BY frac DESC, n DESC, stratum) AS place FROM {name}_a),
{name}_q AS (SELECT stratum, {quota} AS quota FROM {name}_b),
{name} AS (SELECT s.*, row_number() OVER (PARTITION BY s.stratum ORDER BY md5('{seed}|' || s.{key}), s.{key}) <= quota AS picked FROM {source} s JOIN {name}_q USING (stratum))"""


_MULTI = HOUSES + ", m AS (SELECT rec_id, coalesce(dinding, 'unknown') AS stratum FROM h WHERE house_type = 'multi')"
SQL = {
    "split_units": _SPLIT + " SELECT * FROM f",
    "split_summary": _SPLIT + " SELECT new_split, str_split(stratum, '||')[1] AS house_type, count(*) AS units FROM f GROUP BY 1, 2",
    "split_sizes": _UNITS + _SIZES + " SELECT * FROM w",
    "sample_proportional": _MULTI + _sample("m", "p", "rec_id", 300, "42") + " SELECT rec_id, stratum FROM p WHERE picked",
    "sample_remainder": _MULTI + _sample("m", "p", "rec_id", 300, "42") + ", pp AS (SELECT rec_id, stratum FROM p WHERE picked)" + _sample("pp", "r2", "rec_id", 200, "43") + " SELECT rec_id, stratum FROM r2 WHERE NOT picked",
    "sample_unique_groups": "WITH a AS (SELECT rec_id, nullif(lower(trim(source_group_id)), '') AS grp, coalesce(dataset_scheme, 'unknown') AS stratum, lower(trim(split)) AS s FROM sample_15), b AS (SELECT grp, min(rec_id) AS rec_id, arg_min(stratum, rec_id) AS stratum FROM a WHERE grp IS NOT NULL AND grp NOT IN (SELECT grp FROM a WHERE s = 'test' AND grp IS NOT NULL) GROUP BY 1)"
    + _sample("b", "p", "grp", 150, "42", cap=False)
    + " SELECT rec_id, grp, stratum FROM p ORDER BY picked DESC, md5('42|' || grp), grp LIMIT 150",
    "annotator_shards": HOUSES + ", k AS (SELECT rec_id, coalesce(house_type, 'unknown') AS kind FROM h) SELECT rec_id, kind, ((dense_rank() OVER (ORDER BY kind) - 1 + row_number() OVER (PARTITION BY kind ORDER BY md5('42|' || rec_id), rec_id) - 1) % 8)::INT AS shard FROM k",
    "cap_single": HOUSES + "SELECT rec_id FROM (SELECT rec_id, row_number() OVER (PARTITION BY atap ORDER BY rec_id) AS rn FROM h WHERE atap IS NOT NULL) WHERE rn <= 60",
}
