import pytest

import json

from griyaflow.sources import records, sinks
from griyaflow.streaming.events import resume, run_to_end, windowed_counts
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])


def test_json_shapes(spark, tmp_path):
    rows = [{"a": 1, "b": None}, {"a": 2, "b": "x"}]
    (tmp_path / "array.json").write_text(json.dumps(rows))
    (tmp_path / "one.json").write_text(json.dumps(rows[0]))
    (tmp_path / "env.json").write_text(json.dumps({"houses": rows, "n": 2}))
    (tmp_path / "l.jsonl").write_text("\n".join(map(json.dumps, rows)) + "\n\n")
    (tmp_path / "empty.json").write_text("")
    read = lambda name, f=records.read_records: sorted(tuple(r) for r in f(spark, str(tmp_path / name), SCHEMA).collect())
    both = [(1, None), (2, "x")]
    assert read("array.json") == both and read("l.jsonl") == both and read("one.json") == [(1, None)] and read("empty.json") == []
    assert read("env.json", records.read_enveloped) == both and read("array.json", records.read_enveloped) == both


def test_lists_and_rules(spark, tmp_path):
    (tmp_path / "seng.txt").write_text(" u1 \n# no\n\nu2\n")
    (tmp_path / "other.txt").write_text("u3\n")
    lines = records.read_list(spark, str(tmp_path))
    assert sorted(r["value"] for r in lines.collect()) == ["u1", "u2", "u3"]
    got = records.labelled_list(lines, {"seng": ("atap", "Seng", "exterior")}).collect()
    assert sorted((r["value"], r["label"]) for r in got) == [("u1", "Seng"), ("u2", "Seng")]
    assert sorted((r["file"], r["n"]) for r in records.rows_per_file(spark.read.text(str(tmp_path))).collect()) == [("other.txt", 1), ("seng.txt", 4)]


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "é")], SCHEMA)
    p = str(tmp_path / "j")
    sinks.write_json_lines(df, p)
    sinks.write_json_lines(df.limit(1), p, append=True)
    assert records.read_json_lines(spark, p, SCHEMA).count() == 3 and '"b":null' in "".join(x.read_text() for x in (tmp_path / "j").glob("*.json"))
    sinks.write_manifest(df, str(tmp_path / "m"), ["b", "missing", "a"])
    assert records.read_survey(spark, str(tmp_path / "m"), ["a", "missing"]).columns == ["a", "missing"]
    out = str(tmp_path / "s")
    df.write.parquet(out)
    sinks.write_swapped(spark.read.parquet(out).withColumn("a", F.col("a") + 10), out)
    assert sorted(r["a"] for r in spark.read.parquet(out).collect()) == [11, 12]
    assert {(r["a"], r["n"]) for r in sinks.write_shards(df, "a", str(tmp_path / "sh")).collect()} == {(1, 1), (2, 1)}
    sinks.write_lines(df, "a", str(tmp_path / "t"))
    assert spark.read.text(str(tmp_path / "t")).count() == 2


def test_streams(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.createDataFrame([("k1", "2024-01-01 00:00:00", "view", 1.5), ("k2", "2024-01-02 00:00:00", "view", 2.0)], "k string, ts string, event_type string, value double").withColumn("ts", F.to_timestamp("ts")).write.parquet(src)
    read = lambda: spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    got = {(str(r["start"])[:10], r["n"], r["cents"]) for r in run_to_end(windowed_counts(read())).collect()}
    assert got == {("2024-01-01", 1, 150), ("2024-01-02", 1, 200)}
    done = str(tmp_path / "done")
    spark.createDataFrame([("k1", "old")], "k string, out string").write.parquet(done)
    resume(read(), "k", done, lambda b: b.select("k", F.lit("new").alias("out")), str(tmp_path / "state"))
    assert sorted(tuple(r) for r in spark.read.parquet(done).collect()) == [("k1", "old"), ("k2", "new")]


def test_stored_tables_are_released(spark):
    import os

    from griyaflow import runtime

    df = runtime.stored(spark.range(3), "probe")
    path = df._griyaflow_path.removeprefix("file://")
    assert df.count() == 3 and os.path.isdir(path)
    runtime.drop_stored(df)
    assert not os.path.isdir(path)
    again = runtime.stored(spark.range(3), "probe")
    runtime.release(spark)
    assert not os.path.isdir(again._griyaflow_path.removeprefix("file://"))


def test_json_arrays_lose_nothing_silently(spark, tmp_path):
    def read(text):
        path = tmp_path / f"{abs(hash(text))}.json"
        path.write_text(text)
        return sorted((r["a"] for r in records.read_json_array(spark, str(path), "a int").collect()), key=str)

    assert read('[{"a": 1}, 5, "x", null, {"a": 3}, {"b": 1}]') == [1, 3, None] and read(" ") == [] and read("[]") == [] and read('\n{"a": 7}\n') == [7]
    for bad in ('[{"a": 1}, {"a": "oops"}, {"a": 3}]', '[{"a": 1}, {"a": 2}', "no json", "[{'a' 1}]"):
        with pytest.raises(Exception):  # noqa: B017
            read(bad)
