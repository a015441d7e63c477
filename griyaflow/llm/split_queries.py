"""Queries p3_*: linked records and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from griyaflow.llm.linked_splits import assign_splits, parted_rows, parted_sets
from griyaflow.runtime import table


#: The plan is a parameter table; a longer one is refused rather than cut.
MOST_SPLITS = 1000


def _shares(spark: SparkSession, d: str) -> list[tuple[str, float]]:
    """The split plan is a parameter table of a few lines."""
    rows = table(spark, d, "split_plan").orderBy(F.desc("target_share"), "split_name").limit(MOST_SPLITS + 1).collect()
    if len(rows) > MOST_SPLITS:
        raise ValueError(f"split_plan has more than {MOST_SPLITS} lines")
    return [(r["split_name"], float(r["target_share"])) for r in rows]


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return parted_rows(table(spark, d, "sample_15"))


def p3_parted_sets(spark: SparkSession, d: str) -> DataFrame:
    return parted_sets(table(spark, d, "sample_15"))


def p3_assignment(spark: SparkSession, d: str) -> DataFrame:
    return assign_splits(table(spark, d, "sample_15"), _shares(spark, d))


def p3_shares(spark: SparkSession, d: str) -> DataFrame:
    """Rows and share that each new split got, beside its target."""
    got = p3_assignment(spark, d).groupBy("new_split").agg(F.count("*").alias("n_rows"), F.count_distinct("component").alias("n_sets"))
    total = got.agg(F.sum("n_rows").alias("all_rows"))
    plan = table(spark, d, "split_plan").withColumnRenamed("split_name", "new_split")
    return plan.join(got, "new_split", "left").join(F.broadcast(total)).select("new_split", "target_share", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("n_sets", F.lit(0)).alias("n_sets"), (F.coalesce("n_rows", F.lit(0)) / F.col("all_rows")).alias("share"))


QUERIES = {f.__name__: f for f in (p3_found, p3_parted_sets, p3_assignment, p3_shares)}
SQL = {
    "p3_found": r"""
WITH RECURSIVE r AS (
  SELECT rec_id,
    nullif(regexp_replace(upper(trim(house_id)), '_(EXT|INT)$', ''), '') AS h,
    CASE WHEN lower(trim(source_group_id)) IN ('', 'unknown', 'none', 'nan') THEN NULL ELSE lower(trim(source_group_id)) END AS g,
    CASE lower(trim(split)) WHEN 'validation' THEN 'val' WHEN 'train' THEN 'train' WHEN 'val' THEN 'val' WHEN 'test' THEN 'test' END AS s
  FROM sample_15),
e AS (SELECT DISTINCT 'h' || h AS a, 'g' || g AS b FROM r WHERE h IS NOT NULL AND g IS NOT NULL),
m AS (SELECT a, min(b) AS root FROM e GROUP BY a),
x AS (SELECT DISTINCT m.root AS u, e.b AS v FROM e JOIN m USING (a) WHERE e.b <> m.root),
y AS (SELECT u, v FROM x UNION SELECT v, u FROM x),
reach(u, v) AS (SELECT u, v FROM y UNION SELECT reach.u, y.v FROM reach JOIN y ON reach.v = y.u),
lab AS (SELECT u, least(u, min(v)) AS l FROM reach GROUP BY u),
c AS (SELECT r.rec_id, r.s, coalesce(lh.l, m.root, 'h' || r.h, lg.l, 'g' || r.g, 'r' || r.rec_id) AS c
  FROM r LEFT JOIN m ON m.a = 'h' || r.h LEFT JOIN lab lh ON lh.u = m.root LEFT JOIN lab lg ON r.h IS NULL AND lg.u = 'g' || r.g)
SELECT rec_id FROM c WHERE c IN (SELECT c FROM c GROUP BY c HAVING count(DISTINCT s) > 1)
""",
}
