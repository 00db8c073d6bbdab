"""Hand-made messages and envelopes."""

from __future__ import annotations

from google.protobuf import descriptor_pb2, message_factory

from rangelake.functions.types import load_descriptor

F = descriptor_pb2.FieldDescriptorProto
KINDS = {
    "f_bool": F.TYPE_BOOL, "f_i32": F.TYPE_INT32, "f_s32": F.TYPE_SINT32, "f_sf32": F.TYPE_SFIXED32, "f_i64": F.TYPE_INT64, "f_s64": F.TYPE_SINT64, "f_sf64": F.TYPE_SFIXED64, "f_u32": F.TYPE_UINT32, "f_fx32": F.TYPE_FIXED32,
    "f_u64": F.TYPE_UINT64, "f_fx64": F.TYPE_FIXED64, "f_f32": F.TYPE_FLOAT, "f_f64": F.TYPE_DOUBLE, "f_str": F.TYPE_STRING, "f_bytes": F.TYPE_BYTES,
}


def descriptor_set() -> bytes:
    files = descriptor_pb2.FileDescriptorSet()
    f = files.file.add(name="t.proto", package="t", syntax="proto3", dependency=["google/protobuf/timestamp.proto"])

    def message(name):
        return f.message_type.add(name=name)

    def add(m, name, kind, repeated=False, type_name=None, oneof=None, optional=False):
        x = m.field.add(name=name, number=len(m.field) + 1, type=kind, label=F.LABEL_REPEATED if repeated else F.LABEL_OPTIONAL)
        if type_name:
            x.type_name = type_name
        if oneof is not None:
            x.oneof_index = oneof
        if optional:
            x.proto3_optional = True
        return x

    def mapped(m, name, key, value, value_type=None):
        entry = m.nested_type.add(name="".join(p.title() for p in name.split("_")) + "Entry")
        entry.options.map_entry = True
        add(entry, "key", key)
        add(entry, "value", value, type_name=value_type)
        add(m, name, F.TYPE_MESSAGE, True, f".t.{m.name}.{entry.name}")

    e = f.enum_type.add(name="Color")
    for i, n in enumerate(("NONE", "RED", "BLUE")):
        e.value.add(name=n, number=i)
    inner = message("Inner")
    add(inner, "a", F.TYPE_INT32)
    add(inner, "b", F.TYPE_STRING)
    every = message("AllKinds")
    for name, kind in KINDS.items():
        add(every, name, kind)
    add(every, "f_enum", F.TYPE_ENUM, type_name=".t.Color")
    add(every, "f_msg", F.TYPE_MESSAGE, type_name=".t.Inner")
    every.oneof_decl.add(name="o")
    add(every, "f_opt", F.TYPE_INT64, optional=True, oneof=1)
    add(every, "r_i32", F.TYPE_INT32, True)
    add(every, "r_msg", F.TYPE_MESSAGE, True, ".t.Inner")
    mapped(every, "m_si", F.TYPE_STRING, F.TYPE_INT32)
    add(every, "o_a", F.TYPE_INT32, oneof=0)
    add(every, "o_b", F.TYPE_STRING, oneof=0)
    add(every, "f_ts", F.TYPE_MESSAGE, type_name=".google.protobuf.Timestamp")
    every.oneof_decl.add(name="_f_opt")
    item = message("Item")
    add(item, "k", F.TYPE_STRING)
    add(item, "v", F.TYPE_UINT64)
    add(item, "xs", F.TYPE_INT32, True)
    root = message("Root")
    add(root, "n", F.TYPE_INT64)
    add(root, "items", F.TYPE_MESSAGE, True, ".t.Item")
    add(root, "tags", F.TYPE_STRING, True)
    mapped(root, "attrs", F.TYPE_STRING, F.TYPE_INT32)
    add(root, "one", F.TYPE_MESSAGE, type_name=".t.Inner")
    none = message("NoLists")
    add(none, "n", F.TYPE_INT64)
    add(none, "s", F.TYPE_STRING)
    rec = message("Rec")
    add(rec, "v", F.TYPE_INT32)
    add(rec, "next", F.TYPE_MESSAGE, type_name=".t.Rec")
    return files.SerializeToString()


def kind(name: str):
    return message_factory.GetMessageClass(load_descriptor(descriptor_set(), f"t.{name}"))


def data(seq: int, block: int, message=None, block_id: str = "") -> tuple:
    payload = message if isinstance(message, bytes) or message is None else message.SerializeToString()
    return (seq, "data", block, block_id or f"b{block}", payload, f"c{seq}", False, None)


def undo(seq: int, last_valid_block: int) -> tuple:
    return (seq, "undo", None, None, None, f"c{seq}", False, last_valid_block)


def roots() -> list[tuple]:
    root, item = kind("Root"), lambda **x: x
    return [
        data(1, 10, root(n=1, items=[item(k="a", v=1, xs=[1, 2]), item()], tags=["x", "", "y"], attrs={"q": 1})),
        data(2, 11, root(n=2)),
        data(3, 12, root(items=[item(k="b", v=2)])),
    ]
