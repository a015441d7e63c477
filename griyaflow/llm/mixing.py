"""Mixing sources to target weights by weighted fair queueing.

The documents of a source are shuffled by a seeded hash; a document's virtual finish time is the
cumulative size of its source up to and including it, divided by the source's target share. A further
copy of the source follows after all of it. All copies are range-sorted by virtual finish time and the
order is truncated at the total budget: the longest prefix that fits. Running sums are taken over hash
ranges first and within a range then, so no task holds a whole source.

Defined results: null or blank sources and documents of no size are never mixed in; source names are
compared trimmed and lower-cased; a plan line with a null or non-positive share or total, or less than
one repeat, draws nothing; a source that runs out leaves its room to the others, and the report says so;
ties in virtual time go by source, document and copy; repeated document rows are documents each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from griyaflow.functions.keys import blank_to_null
from griyaflow.runtime import stored

RANGES = 1024
#: Virtual time is cut in so many ranges up to the time at which all sources have their share; FAR such spans are told apart.
TIMES, FAR = 4096, 4


def source_name(col) -> F.Column:
    return blank_to_null(F.lower(col))


def fill_time(lines: list[tuple[float, float]], total: float) -> float:
    """The virtual time t at which sum(min(share * t, cap)) reaches ``total``; infinite where it never does."""
    open_, used, share = sorted((cap / w, cap, w) for w, cap in lines if w > 0), 0.0, sum(w for w, _ in lines if w > 0)
    for end, cap, w in open_:
        if used + share * end >= total:
            return (total - used) / share
        used, share = used + cap, share - w
    return float("inf")


def plan_lines(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """Plan lines with the size of all documents of their source and the size that their share asks for."""
    sizes = docs.groupBy("source").agg(F.sum("tokens").alias("source_tokens"), F.max("tokens").alias("longest"))
    asked = plan.select("mix_id", source_name(F.col("source")).alias("source"), "target_share", "max_repeats", "total_tokens")
    lines = asked.join(sizes, "source", "left")
    return lines.select(
        "mix_id", "source", "target_share", "max_repeats", "total_tokens", F.coalesce("longest", F.lit(0)).alias("longest"), F.coalesce("source_tokens", F.lit(0)).alias("source_tokens"),
        (F.coalesce("source_tokens", F.lit(0)) * F.col("max_repeats")).alias("available_tokens"), (F.col("target_share") * F.col("total_tokens")).alias("asked_tokens"),
    )


def mix(docs: DataFrame, plan: DataFrame, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(mix_id, source, doc_id, copy, tokens, finish) of the mixed copies; and the plan lines. docs: (doc_id, source, tokens)."""
    docs = stored(docs.filter("source is not null and tokens > 0").select("doc_id", "source", "tokens"), "sized")
    lines = stored(plan_lines(docs, plan), "lines")
    # the plan is a parameter table: its lines, not documents, come to the driver
    told = [r for r in lines.collect() if (r["target_share"] or 0) > 0 and (r["max_repeats"] or 0) >= 1 and (r["total_tokens"] or 0) > 0 and r["source_tokens"] > 0]
    rows = []
    for m in sorted({r["mix_id"] for r in told}):
        own = [r for r in told if r["mix_id"] == m]
        t = fill_time([(r["target_share"], float(r["available_tokens"])) for r in own], float(own[0]["total_tokens"]))
        span = t if t < float("inf") else max(r["available_tokens"] / r["target_share"] for r in own)
        # whole documents lag behind shares by the longest of each source at most: by then the budget is surely used up
        last = fill_time([(r["target_share"], float(r["available_tokens"])) for r in own], float(own[0]["total_tokens"] + sum(r["longest"] for r in own))) * (1 + 1e-9)
        for r in own:
            copies = min(r["max_repeats"], int(last * r["target_share"] / r["source_tokens"]) + 1 if last < float("inf") else r["max_repeats"])
            rows.append((m, r["source"], float(r["target_share"]), int(r["source_tokens"]), int(copies), float(span), float(last), int(r["total_tokens"])))
    spark = docs.sparkSession
    use = spark.createDataFrame(rows, "mix_id int, source string, share double, source_tokens long, copies int, span double, last double, total long")
    placed = docs.join(F.broadcast(use), "source").withColumn("o", F.xxhash64("doc_id", "mix_id", F.lit(seed).cast("long"))).withColumn("r", F.shiftrightunsigned("o", 54))
    sums = placed.groupBy("mix_id", "source", "r").agg(F.sum("tokens").alias("w"))
    upto = sums.select("mix_id", "source", "r", (F.sum("w").over(Window.partitionBy("mix_id", "source").orderBy("r")) - F.col("w")).alias("before"))
    # row frames: equal documents are peers of the default frame and would share one place
    within = F.sum("tokens").over(Window.partitionBy("mix_id", "source", "r").orderBy("o", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    queued = placed.join(upto, ["mix_id", "source", "r"]).withColumn("upto", F.col("before") + within)
    copies = queued.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    copies = copies.withColumn("finish", ((F.col("copy") - 1) * F.col("source_tokens") + F.col("upto")) / F.col("share"))
    copies = copies.filter("finish <= last").withColumn("at", F.floor(F.least(F.col("finish") / F.col("span"), F.lit(float(FAR))) * TIMES))
    copies = stored(copies.select("mix_id", "source", "doc_id", "copy", "tokens", "finish", "at", "total"), "queued")
    per_range = copies.groupBy("mix_id", "at").agg(F.sum("tokens").alias("w"))
    done = per_range.select("mix_id", "at", (F.sum("w").over(Window.partitionBy("mix_id").orderBy("at")) - F.col("w")).alias("done"))
    in_range = Window.partitionBy("mix_id", "at").orderBy("finish", "source", "doc_id", "copy").rowsBetween(Window.unboundedPreceding, 0)
    ended = copies.join(done, ["mix_id", "at"]).filter("done < total").withColumn("cum", F.col("done") + F.sum("tokens").over(in_range))
    return ended.filter("cum <= total").select("mix_id", "source", "doc_id", "copy", "tokens", "finish"), lines


def mix_report(mixed: DataFrame, lines: DataFrame) -> DataFrame:
    """Per plan line: what its source has, what was asked, what went in, and the share reached."""
    got = mixed.groupBy("mix_id", "source").agg(F.sum("tokens").alias("mixed_tokens"), F.count("*").alias("mixed_copies"), F.max("copy").alias("repeats"))
    whole = F.sum("mixed_tokens").over(Window.partitionBy("mix_id"))
    out = lines.join(got, ["mix_id", "source"], "left").fillna(0, ["mixed_tokens", "mixed_copies", "repeats"])
    return out.drop("longest").withColumn("actual_share", F.coalesce(F.try_divide(F.col("mixed_tokens"), whole), F.lit(0.0))).withColumn("short", F.col("available_tokens") < F.col("asked_tokens"))
