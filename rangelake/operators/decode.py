"""Protobuf payloads to columns: one Arrow function, everything else stays in the JVM."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from functools import cache

import pyarrow as pa
from google.protobuf import message_factory
from google.protobuf.descriptor import FieldDescriptor
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rangelake.functions.types import TIMESTAMP, arrow_type, is_list, is_map, load_descriptor, spark_schema

_UNSIGNED = (FieldDescriptor.TYPE_UINT64, FieldDescriptor.TYPE_FIXED64)
ERROR = "_error"


@cache
def _message_class(descriptor_set: bytes, message: str):
    return message_factory.GetMessageClass(load_descriptor(descriptor_set, message))


def to_row(message, wanted: frozenset[str] | None = None, wkt_timestamps: bool = False) -> dict:
    """Fields that are set, by name; what is missing reads as NULL. List elements and map entries are kept as they are."""

    def scalar(f: FieldDescriptor, value):
        if f.type == FieldDescriptor.TYPE_MESSAGE:
            if wkt_timestamps and f.message_type.full_name == TIMESTAMP:
                return value.seconds * 1_000_000 + value.nanos // 1000
            return to_row(value, None, wkt_timestamps)
        return Decimal(value) if f.type in _UNSIGNED else None if f.type == FieldDescriptor.TYPE_GROUP else value

    out = {}
    for f, value in message.ListFields():
        if wanted is not None and f.name not in wanted:
            continue
        if is_map(f):
            key, item = f.message_type.fields_by_name["key"], f.message_type.fields_by_name["value"]
            out[f.name] = [{"key": scalar(key, k), "value": scalar(item, value[k])} for k in sorted(value)]
        elif is_list(f):
            out[f.name] = [scalar(f, v) for v in value]
        else:
            out[f.name] = scalar(f, value)
    return out


def decode(blocks: DataFrame, descriptor_set: bytes, message: str, fields: list[str] | None = None, mode: str = "FAILFAST", max_depth: int = 16, wkt_timestamps: bool = False, carry: tuple[str, ...] = ("block_number",)) -> DataFrame:
    """The message's columns, behind those of ``blocks`` to carry along.

    ``fields`` prunes what is decoded, which Spark can't do through a Python function. FAILFAST raises on a payload that
    does not parse; PERMISSIVE puts the reason into a column ``_error`` and leaves the others NULL.
    """
    schema = spark_schema(load_descriptor(descriptor_set, message), max_depth, wkt_timestamps)
    if fields is not None:
        missing = set(fields) - set(schema.names)
        if missing:
            raise ValueError(f"{message} has no field {', '.join(sorted(missing))}")
        schema = T.StructType([f for f in schema.fields if f.name in fields])
    wanted = frozenset(schema.names)
    kinds = [(f.name, arrow_type(f.dataType)) for f in schema.fields]
    whole = bool(kinds)
    permissive = mode == "PERMISSIVE"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _message_class(descriptor_set, message)
        for batch in batches:
            rows, errors = [], []
            for number, payload in zip(batch.column("block_number").to_pylist(), batch.column("payload").to_pylist(), strict=True):
                try:
                    parsed = kind.FromString(payload)
                    rows.append(to_row(parsed, wanted, wkt_timestamps) if whole else {})
                    errors.append(None)
                except Exception as e:
                    if not permissive:
                        raise ValueError(f"block {number} does not parse as {message}: {e}") from e
                    rows.append({})
                    errors.append(str(e) or type(e).__name__)
            columns = [batch.column(c) for c in carry] + [pa.array([r.get(n) for r in rows], k) for n, k in kinds]
            names = [*carry, *[n for n, _ in kinds]]
            if permissive:
                columns.append(pa.array(errors, pa.string()))
                names.append(ERROR)
            yield pa.RecordBatch.from_arrays(columns, names)

    carried = [f for f in blocks.schema.fields if f.name in carry]
    carried.sort(key=lambda f: carry.index(f.name))
    out = T.StructType([*carried, *schema.fields, *([T.StructField(ERROR, T.StringType())] if permissive else [])])
    return blocks.filter("payload IS NOT NULL").select(*dict.fromkeys([*carry, "block_number", "payload"])).mapInArrow(run, out)
