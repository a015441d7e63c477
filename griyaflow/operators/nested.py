"""Flattening of nested house records on Arrow buffers.

JSON payloads without a fixed shape are decoded to one typed nested Arrow column per batch,
``list<house<..., images: list<image>>>``. From there no record is touched again: list offsets give
each child's parent index and position, and the parents' keys reach the children by one vectorised
``take``. Columns that are typed already (``images`` of the house table) skip the decoding.

Defined results: a null payload, text that is not valid JSON (NaN and Infinity included), scalars and
empty lists give no rows. Members that are absent or null are empty text in ``item_key`` and null in
the attribute columns. Numbers and booleans keep their written form. A repeated payload gives its
rows again under its own ``raw_id``. Lone surrogates become U+FFFD.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ENVELOPES = ("data", "houses", "records")
VIEWS = ("exterior", "interior")
HOUSE_FIELDS = ("house_id", "kelayakan_rumah", "split", "dataset_scheme", "source_group_id")
IMAGE_FIELDS = (
    "image_hash", "image_path", "folder_name", "view_type", "material_atap", "kondisi_atap",
    "material_dinding", "kondisi_dinding", "material_lantai", "kondisi_lantai",
)
_IMAGE = pa.struct([(f, pa.string()) for f in IMAGE_FIELDS])
_HOUSE = pa.struct(
    [(f, pa.string()) for f in HOUSE_FIELDS]
    + [("pair_kelayakan_rumah", pa.string()), ("stem", pa.string()), ("images", pa.list_(_IMAGE))]
)


class _Invalid(ValueError):
    pass


def _no_constant(_: str) -> None:
    raise _Invalid


def _loads(text: str):
    try:
        return json.loads(text, parse_int=str, parse_float=str, parse_constant=_no_constant)
    except (ValueError, RecursionError):
        raise _Invalid from None


def _held(value):
    """The value, or what it holds when it is JSON kept as text (at any number of layers)."""
    while isinstance(value, str) and value.lstrip(" \t\r\n")[:1] in ("{", "[", '"'):
        try:
            value = _loads(value)
        except _Invalid:
            return value
    return value


def _text(value) -> str | None:
    if value is None:
        return None
    if value is True or value is False:
        return "true" if value else "false"
    if not isinstance(value, str):
        value = json.dumps(value, ensure_ascii=False, separators=(",", ":"))
    try:
        value.encode()
    except UnicodeEncodeError:
        value = value.encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace")
    return value


def _is_house(obj: dict) -> bool:
    return any(k in obj for k in ("house_id", "images", "pair_key", "kelayakan_rumah"))


def _envelope_lists(value) -> Iterator[list]:
    """Lists named ``data``, ``houses`` or ``records`` below ``value``, in written order."""
    value = _held(value)
    if isinstance(value, dict):
        for name, inner in value.items():
            inner = _held(inner)
            if name in ENVELOPES and isinstance(inner, list):
                yield inner
            else:
                yield from _envelope_lists(inner)
    elif isinstance(value, list):
        for inner in value:
            yield from _envelope_lists(inner)


def _houses(value) -> Iterator[dict]:
    value = _held(value)
    if isinstance(value, list):
        for item in value:
            item = _held(item)
            if isinstance(item, dict):
                yield from _houses(item)
    elif isinstance(value, dict):
        if not _is_house(value):
            inside = list(_envelope_lists(value))
            if inside:
                for items in inside:
                    yield from _houses(items)
                return
        yield value


def _images(value) -> Iterator[tuple[dict, str | None]]:
    """Image objects with the view that their list stands under."""
    value = _held(value)
    if isinstance(value, list):
        for item in value:
            item = _held(item)
            if isinstance(item, dict):
                yield item, None
    elif isinstance(value, dict):
        if not any(v in value for v in VIEWS):
            yield value, None
            return
        for view in [*VIEWS, *(k for k in value if k not in VIEWS)]:
            under = _held(value.get(view))
            for item, _ in _images(under) if isinstance(under, (list, dict)) else ():
                yield item, view


def decode_payloads(payloads: list[str | None]) -> pa.ListArray:
    """Typed nested form of JSON payloads: one list of houses per payload."""
    fields: dict[str, list] = {f: [] for f in (*HOUSE_FIELDS, "pair_kelayakan_rumah", "stem")}
    image: dict[str, list] = {f: [] for f in IMAGE_FIELDS}
    per_payload, per_house = [0], [0]
    n_houses = n_images = 0
    for payload in payloads:
        try:
            found = [] if payload is None else [(house, list(_images(house.get("images")))) for house in _houses(_loads(payload))]
        except (_Invalid, RecursionError):  # a payload gives all of its houses or none
            found = []
        for house, pictures in found:
            for f in HOUSE_FIELDS:
                fields[f].append(_text(house.get(f)))
            pair = _held(house.get("pair_key"))
            pair = pair if isinstance(pair, dict) else {}
            fields["pair_kelayakan_rumah"].append(_text(pair.get("kelayakan_rumah")))
            fields["stem"].append(_text(pair.get("stem")))
            for item, view in pictures:
                for f in IMAGE_FIELDS:
                    image[f].append(_text(item.get(f)))
                if view is not None:
                    image["view_type"][-1] = view
            n_images += len(pictures)
            per_house.append(n_images)
        n_houses += len(found)
        per_payload.append(n_houses)
    images = pa.StructArray.from_arrays([pa.array(image[f], pa.string()) for f in IMAGE_FIELDS], fields=list(_IMAGE))
    image_lists = pa.ListArray.from_arrays(pa.array(per_house, pa.int32()), images)
    houses = pa.StructArray.from_arrays([*(pa.array(fields[f], pa.string()) for f in fields), image_lists], fields=list(_HOUSE))
    return pa.ListArray.from_arrays(pa.array(per_payload, pa.int32()), houses)


def child_rows(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Children of a list column, each child's parent index and its position below that parent."""
    parent = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    n = len(lists)
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.zeros(n, np.int64)
    if n:
        np.cumsum(lengths[:-1], out=starts[1:])
    return pc.list_flatten(lists), parent, np.arange(len(parent), dtype=np.int64) - starts[parent]


_OUT = {
    "house_pos": ("int", pa.int32()), "entity": ("string", pa.string()), "item_pos": ("int", pa.int32()), "item_key": ("string", pa.string()),
    **{f: ("string", pa.string()) for f in (*HOUSE_FIELDS, "pair_kelayakan_rumah", "stem", *IMAGE_FIELDS)},
}


def _emit(ids: pa.Array, lists: pa.ListArray, entities: tuple[str, ...], columns: list[str], id_name: str, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    houses, payload_of, house_pos = child_rows(lists)
    n = len(houses)
    if not n:
        return
    schema = pa.schema([(id_name, id_type), *((c, _OUT[c][1]) for c in columns)])
    raw_ids = ids.take(pa.array(payload_of))
    house_of = {f: pc.struct_field(houses, f) for f in (*HOUSE_FIELDS, "pair_kelayakan_rumah", "stem")}

    def batch(entity: str, house: np.ndarray | None, item_pos: np.ndarray, key: pa.Array, own: dict[str, pa.Array]) -> pa.RecordBatch:
        size = len(item_pos)
        up = (lambda a: a) if house is None else (lambda a, i=pa.array(house): a.take(i))
        made = {
            "house_pos": lambda: up(pa.array(house_pos, pa.int32())), "entity": lambda: pa.array([entity]).take(pa.array(np.zeros(size, np.int32))),
            "item_pos": lambda: pa.array(item_pos, pa.int32()), "item_key": lambda: pc.fill_null(key, ""),
        }
        out = [up(raw_ids)]
        for c in columns:
            if c in made:
                out.append(made[c]())
            elif c in own:
                out.append(own[c])
            elif c in HOUSE_FIELDS:
                out.append(up(house_of[c]))
            else:
                out.append(pa.nulls(size, _OUT[c][1]))
        return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(out, schema, strict=True)], schema=schema)

    if "house" in entities:
        yield batch("house", None, np.zeros(n, np.int64), house_of["house_id"], {})
    if "pair_key" in entities:
        have = np.flatnonzero(pc.is_valid(house_of["stem"]).to_numpy(zero_copy_only=False))
        at = pa.array(have)
        yield batch("pair_key", have, np.zeros(len(have), np.int64), house_of["stem"].take(at), {f: house_of[f].take(at) for f in ("pair_kelayakan_rumah", "stem")})
    if "image" in entities:
        images, house, pos = child_rows(pc.struct_field(houses, "images"))
        if len(images):
            own = {f: pc.struct_field(images, f) for f in IMAGE_FIELDS}
            key = pc.binary_join_element_wise(pc.fill_null(own["view_type"], ""), pc.fill_null(own["image_path"], ""), "|")
            yield batch("image", house, pos, key, own)


def flat_tables(df: DataFrame, id_col: str = "raw_id", payload_col: str = "payload", entities: tuple[str, ...] = ("house", "pair_key", "image"), columns: tuple[str, ...] = tuple(_OUT)) -> DataFrame:
    """The flat tables of JSON payloads, one row per house, pair key and image, told apart by ``entity``.

    Each row carries (``id_col``, ``house_pos``), the key of its house, and ``item_pos`` below it."""
    source = df.select(F.col(id_col).alias("id"), F.col(payload_col).alias("payload"))
    cols = list(columns)
    ddl = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, " + ", ".join(f"{c} {_OUT[c][0]}" for c in cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # bounded slices: long payloads do not pile up beside their decoded form
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                yield from _emit(part.column(0), decode_payloads(part.column(1).to_pylist()), entities, cols, id_col, part.column(0).type)

    return source.mapInArrow(run, ddl)


def flat_typed(df: DataFrame, id_col: str = "rec_id", entities: tuple[str, ...] = ("house", "pair_key", "image"), columns: tuple[str, ...] = tuple(_OUT)) -> DataFrame:
    """As :func:`flat_tables`, for a table whose records are typed already (one house per row)."""
    source = df.select(F.col(id_col).alias("id"), *HOUSE_FIELDS, F.col("pair_key.kelayakan_rumah").alias("pair_kelayakan_rumah"), F.col("pair_key.stem").alias("stem"), "images")
    cols = list(columns)
    ddl = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, " + ", ".join(f"{c} {_OUT[c][0]}" for c in cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            houses = pa.StructArray.from_arrays(b.columns[1:], names=b.schema.names[1:])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1), pa.int32()), houses)
            yield from _emit(b.column(0), lists, entities, cols, id_col, b.column(0).type)

    return source.mapInArrow(run, ddl)
