"""Queries p1_*: samples asked for in sample_plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from griyaflow.functions.keys import choice, house_key
from griyaflow.llm.balanced import WORD, bits_of, category_masks, sample_to_plan
from griyaflow.runtime import table

COMPONENTS = ("atap", "dinding", "lantai")
#: The plan is a parameter table; a longer one is refused rather than brought to the driver.
MOST_LINES = 100_000


def _or_bits(materials: Column, code: dict[str, int], n_words: int, w: int) -> Column:
    return F.aggregate(materials, F.lit(0).cast("long"), lambda acc, m: acc.bitwiseOR(bits_of(F.lower(F.trim(m)), code, n_words)[w]))


def _sampled(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    plan = [r.asDict() for r in table(spark, d, "sample_plan").orderBy("plan_id", "component", "category").limit(MOST_LINES + 1).collect()]
    if len(plan) > MOST_LINES:
        raise ValueError(f"sample_plan has more than {MOST_LINES} lines")
    cats = sorted({(r["component"], r["category"]) for r in plan})
    n_words = max(1, -(-len(cats) // WORD))
    own = {comp: {cat: i for i, (c, cat) in enumerate(cats) if c == comp} for comp in (*COMPONENTS, "kelayakan_rumah")}
    rows = table(spark, d, "sample_15")
    zero = F.lit(0).cast("long")

    def any_bits(w: int) -> Column:
        """Bits of all pictures; each component is read as an array of its own, so a scan reads no other field."""
        out = bits_of(choice(F.col("kelayakan_rumah")), own["kelayakan_rumah"], n_words)[w]
        for comp in COMPONENTS:
            out = out.bitwiseOR(F.coalesce(_or_bits(F.col(f"images.material_{comp}"), own[comp], n_words, w), zero))
        return out

    found = [any_bits(w) for w in range(n_words)]
    units = category_masks(rows, house_key(F.col("house_id")), found, len(cats))
    return sample_to_plan(units, plan, cats)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the sampling report whose pool is too small."""
    return _sampled(spark, d)[1].filter("status = 'pool_too_small'").select("plan_id", "component", "category")


def p1_sample(spark: SparkSession, d: str) -> DataFrame:
    return _sampled(spark, d)[0].withColumnRenamed("unit", "house_id")


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    """Per plan line: pool, what was asked and drawn, the residual imbalance and whether it is met."""
    return _sampled(spark, d)[1]


def p1_lines(spark: SparkSession, d: str) -> DataFrame:
    """Of the report: pool and asked count of every line."""
    return _sampled(spark, d)[1].select("plan_id", "component", "category", "pool", F.round("asked", 6).alias("asked"))


QUERIES = {f.__name__: f for f in (p1_found, p1_sample, p1_report, p1_lines)}
_POOLS = r"""
WITH r AS (SELECT upper(trim(house_id)) AS h, regexp_replace(lower(trim(kelayakan_rumah)), '[ _-]+', '_', 'g') AS kel, images FROM sample_15 WHERE trim(house_id) <> ''),
i AS (SELECT h, unnest(images) AS im FROM r),
c AS (SELECT 'kelayakan_rumah' AS component, kel AS category, h FROM r
  UNION SELECT 'atap', lower(trim(im.material_atap)), h FROM i UNION SELECT 'dinding', lower(trim(im.material_dinding)), h FROM i UNION SELECT 'lantai', lower(trim(im.material_lantai)), h FROM i),
n AS (SELECT component, category, count(DISTINCT h) AS n FROM c GROUP BY 1, 2)
"""
SQL = {
    "p1_found": _POOLS + "SELECT plan_id, p.component, p.category FROM sample_plan p LEFT JOIN n USING (component, category) WHERE coalesce(n, 0) < greatest(min_count, target_share * sample_size)",
    "p1_lines": _POOLS
    + """SELECT plan_id, p.component, p.category, coalesce(n, 0) AS pool, round(greatest(min_count, target_share * sample_size), 6)::DOUBLE AS asked FROM sample_plan p LEFT JOIN n USING (component, category)""",
}
