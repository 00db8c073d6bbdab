from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rangelake.functions.presence import entries, enum_number, with_presence
from rangelake.functions.types import list_fields, load_descriptor, spark_schema
from rangelake.operators.decode import ERROR, decode
from rangelake.sources.envelope import ENVELOPE, raw_table, with_payload
from tests.fixtures import KINDS, data, descriptor_set, kind

SET = descriptor_set()


def frame(spark, rows):
    return spark.createDataFrame(rows, ENVELOPE)


def test_schema_of_all_kinds():
    types = {f.name: f.dataType.simpleString() for f in spark_schema(load_descriptor(SET, "t.AllKinds"))}
    expected = ["boolean", "int", "int", "int", "bigint", "bigint", "bigint", "bigint", "bigint", "decimal(20,0)", "decimal(20,0)", "float", "double", "string", "binary"]
    assert [types[k] for k in KINDS] == expected
    assert types["f_enum"] == "int" and types["f_msg"] == "struct<a:int,b:string>" and types["r_msg"] == "array<struct<a:int,b:string>>"
    assert types["m_si"] == "array<struct<key:string,value:int>>" and types["o_a"] == "int" and types["f_ts"] == "struct<seconds:bigint,nanos:int>"
    assert list_fields(load_descriptor(SET, "t.AllKinds")) == ["r_i32", "r_msg"]


def test_decode_all_kinds(spark):
    every = kind("AllKinds")
    highest = every(f_bool=True, f_i32=2**31 - 1, f_i64=2**63 - 1, f_u32=2**32 - 1, f_u64=2**64 - 1, f_str="ß", f_bytes=b"\0", f_enum=2, o_b="x", m_si={"b": 2, "a": 1})
    lowest = every(f_i32=-(2**31), f_i64=-(2**63), f_f64=-1.5)
    explicit = every(f_opt=0, r_i32=[0, 1], r_msg=[{}], m_si={"": 0}, f_msg={})
    rows = decode(frame(spark, [data(1, 1, every()), data(2, 2, highest), data(3, 3, lowest), data(4, 4, explicit)]), SET, "t.AllKinds").orderBy("block_number").collect()
    assert all(v is None for k, v in rows[0].asDict().items() if k != "block_number")
    assert rows[1]["f_u64"] == Decimal(2**64 - 1) and rows[1]["f_u32"] == 2**32 - 1 and rows[1]["f_enum"] == 2
    assert rows[1]["o_b"] == "x" and rows[1]["o_a"] is None and [tuple(e) for e in rows[1]["m_si"]] == [("a", 1), ("b", 2)]
    assert rows[2]["f_i32"] == -(2**31) and rows[2]["f_i64"] == -(2**63) and rows[2]["f_f64"] == -1.5
    assert rows[3]["f_opt"] == 0 and rows[3]["r_i32"] == [0, 1] and tuple(rows[3]["r_msg"][0]) == (None, None)
    assert [tuple(e) for e in rows[3]["m_si"]] == [("", 0)] and tuple(rows[3]["f_msg"]) == (None, None)


def test_timestamps_on_demand(spark):
    every = kind("AllKinds")
    message = every()
    message.f_ts.seconds, message.f_ts.nanos = 86400, 5000
    row = decode(frame(spark, [data(1, 1, message)]), SET, "t.AllKinds", ["f_ts"], wkt_timestamps=True).select(F.date_format("f_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("t")).first()
    assert row["t"] == "1970-01-02 00:00:00.000005"
    plain = decode(frame(spark, [data(1, 1, message)]), SET, "t.AllKinds", ["f_ts"]).first()
    assert tuple(plain["f_ts"]) == (86400, 5000)
    assert datetime.datetime(1970, 1, 2)


def test_pruned_fields(spark):
    df = decode(frame(spark, [data(1, 1, kind("Root")(n=5, tags=["a"]))]), SET, "t.Root", ["tags"])
    assert df.columns == ["block_number", "tags"] and df.first()["tags"] == ["a"]
    with pytest.raises(ValueError, match="no field"):
        decode(frame(spark, []), SET, "t.Root", ["nope"])


def test_bad_payloads(spark):
    good = kind("Root")(n=1).SerializeToString()
    rows = frame(spark, [data(1, 20, good), data(2, 21, b"\x12\x99"), data(3, 22, good)])
    with pytest.raises(Exception, match="block 21"):
        decode(rows, SET, "t.Root").collect()
    out = decode(rows, SET, "t.Root", mode="PERMISSIVE")
    assert {r["block_number"] for r in out.filter(F.col(ERROR).isNull()).collect()} == {20, 22}
    assert out.filter(F.col(ERROR).isNotNull()).first()["block_number"] == 21


def test_missing_payload(spark):
    good = kind("Root")(n=1)
    rows = frame(spark, [data(1, 30, good), data(2, 31, None), data(3, 32, good)])
    assert with_payload(rows).count() == 2 and decode(rows, SET, "t.Root").count() == 2


def test_descriptor_errors():
    with pytest.raises(ValueError, match="no message"):
        load_descriptor(SET, "t.Nope")
    with pytest.raises(ValueError, match="not a file descriptor set"):
        load_descriptor(b"\xff\xff\xff", "t.Root")
    with pytest.raises(ValueError, match="nest deeper"):
        spark_schema(load_descriptor(SET, "t.Rec"))


def test_raw_table(spark):
    df = raw_table(frame(spark, [data(1, 7, b"x"), data(2, 8, None)]))
    assert df.schema["block_number"].dataType.simpleString() == "decimal(20,0)"
    assert [tuple(r) for r in df.collect()] == [(Decimal(7), "b7", b"x")]


def test_presence_of_plain_tables(spark):
    df = spark.createDataFrame([(0, "", [], {}, 0), (1, "a", [0], {"b": 0, "a": 1}, 0)], "n int, s string, l array<int>, m map<string,int>, k int")
    zero, full = with_presence(df, keep=("k",)).orderBy("n").collect()
    assert tuple(zero) == (None, None, None, None, 0)
    assert full["l"] == [0] and [tuple(e) for e in full["m"]] == [("a", 1), ("b", 0)] and full["k"] == 0
    assert df.select(entries(F.col("m")).alias("m"), enum_number(F.col("s"), {"a": 3}).alias("e")).orderBy("e").collect()[1]["e"] == 3
