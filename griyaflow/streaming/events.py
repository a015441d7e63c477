"""Streams: windowed counts with late data, and incremental work that skips what is done."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from griyaflow.runtime import shared_dir


def windowed_counts(events: DataFrame, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Events and value per window and type; rows later than ``late`` are dropped on a stream."""
    win = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type")
    return win.agg(F.count("*").alias("n"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents")).select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n", "cents")


def run_to_end(rows: DataFrame, mode: str = "complete") -> DataFrame:
    """Runs a streaming table over all that is there and returns what the sink holds; state lives in the shared folder."""
    spark = rows.sparkSession
    base = f"{shared_dir(spark)}/griyaflow-stream-{uuid.uuid4().hex}"
    out = f"{base}/out"

    def keep(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite" if mode == "complete" else "append").parquet(out)

    query = rows.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).foreachBatch(keep).start()
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(out)


def resume(rows: DataFrame, key: str, done_path: str, work: Callable[[DataFrame], DataFrame], checkpoint: str) -> None:
    """Works on the records of a stream whose key is not in the table at ``done_path``, and appends the results there."""
    spark = rows.sparkSession

    def step(batch: DataFrame, _: int) -> None:
        fresh = batch.dropDuplicates([key])
        path = spark._jvm.org.apache.hadoop.fs.Path(done_path)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            fresh = fresh.join(spark.read.parquet(done_path).select(key).distinct(), key, "left_anti")
        work(fresh).write.mode("append").parquet(done_path)

    rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(step).start().awaitTermination()


def read_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)
