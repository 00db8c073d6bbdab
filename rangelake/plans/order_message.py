"""A message for the orders table, to run the decoder on whole tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from google.protobuf import descriptor_pb2, message_factory
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangelake.functions.types import load_descriptor

MESSAGE, NESTED = "rangelake.Order", "rangelake.Nested"


def descriptor_set() -> bytes:
    files = descriptor_pb2.FileDescriptorSet()
    f = files.file.add(name="order.proto", package="rangelake", syntax="proto3")
    kinds = descriptor_pb2.FieldDescriptorProto
    state = f.enum_type.add(name="State")
    for number, name in enumerate(("UNKNOWN", "OPEN", "FULFILLED", "PENDING")):
        state.value.add(name=name, number=number)
    order = f.message_type.add(name="Order")
    order.field.add(name="custkey", number=1, type=kinds.TYPE_INT64, label=kinds.LABEL_OPTIONAL)
    order.field.add(name="status", number=2, type=kinds.TYPE_STRING, label=kinds.LABEL_OPTIONAL)
    order.field.add(name="state", number=3, type=kinds.TYPE_ENUM, type_name=".rangelake.State", label=kinds.LABEL_OPTIONAL)
    line = f.message_type.add(name="Line")
    for number, (name, kind) in enumerate((("linenumber", kinds.TYPE_INT64), ("partkey", kinds.TYPE_UINT64), ("quantity", kinds.TYPE_DOUBLE), ("returnflag", kinds.TYPE_STRING)), 1):
        line.field.add(name=name, number=number, type=kind, label=kinds.LABEL_OPTIONAL)
    nested = f.message_type.add(name="Nested")
    nested.field.add(name="custkey", number=1, type=kinds.TYPE_INT64, label=kinds.LABEL_OPTIONAL)
    nested.field.add(name="lines", number=2, type=kinds.TYPE_MESSAGE, type_name=".rangelake.Line", label=kinds.LABEL_REPEATED)
    return files.SerializeToString()


def encode_orders(orders: DataFrame, states: dict[str, int]) -> DataFrame:
    """block_number and payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = message_factory.GetMessageClass(load_descriptor(descriptor_set(), MESSAGE))
        for batch in batches:
            rows = zip(batch.column("o_custkey").to_pylist(), batch.column("o_orderstatus").to_pylist(), strict=True)
            payloads = [kind(custkey=c or 0, status=s or "", state=states.get(s, 0)).SerializeToString() for c, s in rows]
            yield pa.RecordBatch.from_arrays([batch.column("block_number"), pa.array(payloads, pa.binary())], ["block_number", "payload"])

    return orders.select(F.col("o_orderkey").alias("block_number"), "o_custkey", "o_orderstatus").mapInArrow(run, "block_number long, payload binary")


def encode_nested(orders: DataFrame) -> DataFrame:
    """block_number and payload of orders with their list of lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = message_factory.GetMessageClass(load_descriptor(descriptor_set(), NESTED))
        for batch in batches:
            rows = zip(batch.column("o_custkey").to_pylist(), batch.column("lines").to_pylist(), strict=True)
            payloads = [kind(custkey=c or 0, lines=[{k: v for k, v in x.items() if v is not None} for x in lines or ()]).SerializeToString() for c, lines in rows]
            yield pa.RecordBatch.from_arrays([batch.column("block_number"), pa.array(payloads, pa.binary())], ["block_number", "payload"])

    def line(x):
        return F.struct(x["l_linenumber"].cast("long").alias("linenumber"), x["l_partkey"].alias("partkey"), x["l_quantity"].cast("double").alias("quantity"), x["l_returnflag"].alias("returnflag"))

    return orders.select("block_number", "o_custkey", F.transform("lines", line).alias("lines")).mapInArrow(run, "block_number long, payload binary")
