"""Queries p4_*: pictures of val and test houses that training also holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from griyaflow.llm.overlap import overlap_by_split, overlap_classes, overlapping_pairs
from griyaflow.runtime import table


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = overlapping_pairs(table(spark, d, "sample_15"), table(spark, d, "placeholder_hashes"))
    return pairs.select(F.least("train_id", "eval_id").alias("rec_a"), F.greatest("train_id", "eval_id").alias("rec_b"))


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return overlap_by_split(table(spark, d, "sample_15"), table(spark, d, "placeholder_hashes"))


def p4_classes(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of pictures instead of pairs of records, with the records of each."""
    return overlap_classes(table(spark, d, "sample_15"), table(spark, d, "placeholder_hashes")).drop("covered")


QUERIES = {f.__name__: f for f in (p4_found, p4_report, p4_classes)}
_NEAR = r"""
WITH i AS (SELECT rec_id, CASE lower(trim(split)) WHEN 'validation' THEN 'val' ELSE lower(trim(split)) END AS s, regexp_replace(lower(trim(unnest(images).image_hash)), '^\w+:', '') AS h FROM sample_15),
p AS (SELECT DISTINCT rec_id, s = 'train' AS train, h FROM i WHERE s IN ('train', 'val', 'test') AND regexp_full_match(h, '[0-9a-f]{64}') AND h NOT IN (SELECT image_hash FROM placeholder_hashes)),
u AS (SELECT h, train, ('0x' || substr(h, 1, 16))::UBIGINT AS a, ('0x' || substr(h, 17, 16))::UBIGINT AS b, ('0x' || substr(h, 33, 16))::UBIGINT AS c, ('0x' || substr(h, 49, 16))::UBIGINT AS d FROM (SELECT DISTINCT h, train FROM p)),
n AS (SELECT t.h AS th, e.h AS eh, bit_count(xor(t.a, e.a))::INT + bit_count(xor(t.b, e.b))::INT + bit_count(xor(t.c, e.c))::INT + bit_count(xor(t.d, e.d))::INT AS bits,
  lpad(bin(xor(t.a, e.a)), 64, '0') || lpad(bin(xor(t.b, e.b)), 64, '0') || lpad(bin(xor(t.c, e.c)), 64, '0') || lpad(bin(xor(t.d, e.d)), 64, '0') AS x FROM u t JOIN u e ON t.train AND NOT e.train AND bit_count(xor(t.a, e.a))::INT + bit_count(xor(t.b, e.b))::INT + bit_count(xor(t.c, e.c))::INT + bit_count(xor(t.d, e.d))::INT <= 10)
"""
SQL = {
    "p4_found": _NEAR
    + """SELECT DISTINCT least(t.rec_id, e.rec_id) AS rec_a, greatest(t.rec_id, e.rec_id) AS rec_b
FROM n JOIN p t ON t.h = n.th AND t.train JOIN p e ON e.h = n.eh AND NOT e.train""",
    "p4_classes": _NEAR
    + """SELECT th AS train_hash, eh AS eval_hash, bits, (SELECT count(*) FROM p WHERE h = th AND train) AS n_train, (SELECT count(*) FROM p WHERE h = eh AND NOT train) AS n_eval FROM n""",
    "p4_report": _NEAR
    + """, s AS (SELECT *, list_transform(range(0, 11), lambda k: {'a': 256 * k // 11, 'n': 256 * (k + 1) // 11 - 256 * k // 11, 'b': 256 * k // 11 + instr(substr(x || '1', 256 * k // 11 + 1), '1') - 1}) AS l FROM n),
v AS (SELECT *, len(list_filter(range(0, 256), lambda i: len(list_filter(l, lambda z: z.b - z.a >= z.n AND z.a <= i AND i < z.b)) > 0)) AS covered FROM s),
x AS (SELECT e.rec_id, min(v.bits) AS bits, max(v.covered) AS covered FROM v JOIN p e ON e.h = v.eh AND NOT e.train GROUP BY 1),
r AS (SELECT s.rec_id, CASE lower(trim(split)) WHEN 'validation' THEN 'val' ELSE lower(trim(split)) END AS split, coalesce(lower(trim(source_group_id)), '') AS source_group, bits, covered FROM sample_15 s LEFT JOIN x USING (rec_id))
SELECT split, source_group, count(*) AS n_records, count(bits) AS n_overlapping, count(*) FILTER (bits = 0) AS n_exact, avg(covered / 256.0)::DOUBLE AS mean_coverage FROM r WHERE split IN ('val', 'test') GROUP BY 1, 2 HAVING count(bits) > 0""",
}
