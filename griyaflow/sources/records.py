"""Readers: JSON in its shapes, text lists, spreadsheets as CSV, multi-file scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from griyaflow.operators.nested import ENVELOPES


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines, blank ones skipped; a malformed line fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Files that hold one JSON array or one object; a blank file gives no row. Items of an array that are no objects are
    left out by their first character; a file that is no whole JSON, or an object that does not fit the schema, fails the read.
    A file is one row while it is cut into items: at most 2 GB each."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    text = F.regexp_replace("value", r"^[\s\ufeff]+|\s+$", "")
    files = spark.read.text(path, wholetext=True).select(text.alias("value"), F.col("_metadata.file_path").alias("file")).filter("value <> ''")
    broken = F.raise_error(F.concat(F.lit("no JSON array or object: "), F.col("file"))).cast("array<string>")
    whole = F.col("value").startswith("[") & F.col("value").endswith("]") & F.try_parse_json("value").isNotNull()
    items = F.when(F.col("value").startswith("{"), F.array("value")).when(whole, F.from_json("value", T.ArrayType(T.StringType()))).otherwise(broken)
    objects = files.select(F.explode(F.filter(F.coalesce(items, broken), lambda x: x.startswith("{"))).alias("item"))
    return objects.select(F.from_json("item", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def read_enveloped(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A list, or the list under ``data``, ``houses`` or ``records``, per file."""
    inner = T.ArrayType(schema)
    files = spark.read.text(path, wholetext=True)
    outer = T.StructType([T.StructField(e, inner) for e in ENVELOPES])
    text = F.trim("value")
    items = F.when(text.startswith("["), F.from_json("value", inner)).otherwise(F.coalesce(*[F.from_json("value", outer)[e] for e in ENVELOPES]))
    return files.select(F.explode(items).alias("r")).select("r.*")


def read_records(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """By extension: ``.jsonl`` line by line, otherwise whole files; a folder is read with all its files."""
    return read_json_lines(spark, path, schema) if path.rstrip("/").endswith(".jsonl") else read_json_array(spark, path, schema)


def read_list(spark: SparkSession, path: str, comments: bool = True) -> DataFrame:
    """Lines of a text list (value, file): stripped, blank ones and, if asked, ``#`` lines dropped."""
    lines = spark.read.text(path).select(F.regexp_replace("value", r"^\s+|\s+$", "").alias("value"), F.col("_metadata.file_name").alias("file"))
    lines = lines.filter("value <> ''")
    return lines.filter(~F.col("value").startswith("#")) if comments else lines


def read_survey(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Spreadsheet export as CSV: every cell text, only the needed columns."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path).select(*columns)


def rows_per_file(rows: DataFrame) -> DataFrame:
    """(file, n) of a multi-file scan."""
    return rows.select(F.col("_metadata.file_name").alias("file")).groupBy("file").agg(F.count("*").alias("n"))


def labelled_list(lines: DataFrame, rules: dict[str, tuple[str, str, str]]) -> DataFrame:
    """Lines with the label rule of their file's stem; files without a rule are skipped. rules: stem -> (component, label, view)."""
    spark = lines.sparkSession
    table = spark.createDataFrame([(k, *v) for k, v in rules.items()], "stem string, component string, label string, view string")
    return lines.withColumn("stem", F.regexp_replace("file", r"\.[^.]*$", "")).join(F.broadcast(table), "stem")
