"""Content keys, data links and JSON answers inside text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from griyaflow.functions.text import mime_type, strip


def content_key(*cols: Column) -> Column:
    """SHA-1 of a record's content as JSON; equal content has an equal key."""
    return F.sha1(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}))


def data_link(path: Column, content: Column) -> Column:
    return F.concat(F.lit("data:"), mime_type(path), F.lit(";base64,"), F.base64(content))


def fenced_json(text: Column) -> Column:
    """The JSON of an answer without its code fence; null when there is none."""
    bare = strip(F.regexp_replace(text, r"```(json)?", ""))
    return F.when(bare.startswith("{") & bare.endswith("}"), bare)


def answer_field(json: Column, name: str) -> Column:
    """A member of an answer as text; an object with a reason of its own gives that; what is missing or malformed is empty."""
    value = F.from_json(json, "map<string,string>")[name]
    inner = F.when(value.startswith("{"), F.get_json_object(value, "$.alasan")).otherwise(value)
    return strip(F.coalesce(inner, F.lit("")))
