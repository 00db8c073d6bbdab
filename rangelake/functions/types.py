"""Protobuf descriptors to Spark and Arrow types, once, on the driver."""

from __future__ import annotations

import importlib

import pyarrow as pa
from google.protobuf import descriptor_pb2, descriptor_pool
from google.protobuf.descriptor import Descriptor, FieldDescriptor
from pyspark.sql import types as T

# Field kind to Spark type. Unsigned 32-bit numbers take a long, 64-bit ones a decimal.
_KINDS = {
    FieldDescriptor.TYPE_BOOL: T.BooleanType(), FieldDescriptor.TYPE_INT32: T.IntegerType(), FieldDescriptor.TYPE_SINT32: T.IntegerType(), FieldDescriptor.TYPE_SFIXED32: T.IntegerType(),
    FieldDescriptor.TYPE_INT64: T.LongType(), FieldDescriptor.TYPE_SINT64: T.LongType(), FieldDescriptor.TYPE_SFIXED64: T.LongType(), FieldDescriptor.TYPE_UINT32: T.LongType(), FieldDescriptor.TYPE_FIXED32: T.LongType(),
    FieldDescriptor.TYPE_UINT64: T.DecimalType(20, 0), FieldDescriptor.TYPE_FIXED64: T.DecimalType(20, 0), FieldDescriptor.TYPE_FLOAT: T.FloatType(), FieldDescriptor.TYPE_DOUBLE: T.DoubleType(),
    FieldDescriptor.TYPE_STRING: T.StringType(), FieldDescriptor.TYPE_BYTES: T.BinaryType(), FieldDescriptor.TYPE_ENUM: T.IntegerType(), FieldDescriptor.TYPE_GROUP: T.BinaryType(),
}
TIMESTAMP = "google.protobuf.Timestamp"


def load_descriptor(descriptor_set: bytes, message: str) -> Descriptor:
    """The descriptor of ``message`` in a serialised FileDescriptorSet; files may come in any order."""
    files = descriptor_pb2.FileDescriptorSet()
    try:
        files.ParseFromString(descriptor_set)
    except Exception as e:
        raise ValueError(f"not a file descriptor set: {e}") from e
    pool = descriptor_pool.DescriptorPool()
    by_name, done = {f.name: f for f in files.file}, set()

    def add(name: str) -> None:
        if name in done:
            return
        done.add(name)
        if name not in by_name:
            if name.startswith("google/protobuf/"):
                importlib.import_module(name.removesuffix(".proto").replace("/", ".") + "_pb2")  # registers the file
                known = descriptor_pool.Default().FindFileByName(name)
                own = descriptor_pb2.FileDescriptorProto()
                known.CopyToProto(own)
                by_name[name] = own
            else:
                raise ValueError(f"the descriptor set lacks {name}")
        for dependency in by_name[name].dependency:
            add(dependency)
        pool.Add(by_name[name])

    for f in files.file:
        add(f.name)
    try:
        return pool.FindMessageTypeByName(message)
    except KeyError as e:
        raise ValueError(f"the descriptor set has no message {message!r}") from e


def is_list(field: FieldDescriptor) -> bool:
    return field.is_repeated


def is_map(field: FieldDescriptor) -> bool:
    return is_list(field) and field.type == FieldDescriptor.TYPE_MESSAGE and field.message_type.GetOptions().map_entry


def list_fields(message: Descriptor) -> list[str]:
    """Root fields that explode makes tables of: repeated, and not a map."""
    return [f.name for f in message.fields if is_list(f) and not is_map(f)]


def spark_schema(message: Descriptor, max_depth: int = 16, wkt_timestamps: bool = False, _path: tuple[str, ...] = ()) -> T.StructType:
    """Columns in the order of the descriptor's fields, all nullable; messages deeper than ``max_depth`` raise."""
    path = (*_path, message.full_name)
    if len(path) > max_depth:
        raise ValueError(f"messages nest deeper than {max_depth}: {' > '.join(path[:4])} ...")

    def one(f: FieldDescriptor) -> T.DataType:
        if f.type != FieldDescriptor.TYPE_MESSAGE:
            return _KINDS[f.type]
        if wkt_timestamps and f.message_type.full_name == TIMESTAMP:
            return T.TimestampType()
        return spark_schema(f.message_type, max_depth, wkt_timestamps, path)

    return T.StructType([T.StructField(f.name, T.ArrayType(one(f)) if is_list(f) else one(f)) for f in message.fields])


def arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.StructType):
        return pa.struct([pa.field(f.name, arrow_type(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return pa.list_(arrow_type(kind.elementType))
    if isinstance(kind, T.DecimalType):
        return pa.decimal128(kind.precision, kind.scale)
    plain = {T.BooleanType: pa.bool_(), T.IntegerType: pa.int32(), T.LongType: pa.int64(), T.FloatType: pa.float32(), T.DoubleType: pa.float64(), T.StringType: pa.string(), T.BinaryType: pa.binary(), T.TimestampType: pa.timestamp("us", "UTC")}
    return plain[type(kind)]
