"""Null rules as column expressions: a value at its default, or an empty collection, is absent and reads as NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def absent_if(value: Column, default: object) -> Column:
    return F.nullif(value, F.lit(default))


def absent_if_empty(value: Column) -> Column:
    """An array or map without elements as NULL."""
    return F.when(F.size(value) > 0, value)


def entries(value: Column) -> Column:
    """A map as a list of key and value, sorted by key; NULL if empty."""
    return absent_if_empty(F.array_sort(F.map_entries(value)))


def enum_number(value: Column, names: dict[str, int]) -> Column:
    """An enum's number by its name; unknown names are NULL."""
    out = F.lit(None).cast("int")
    for name, number in names.items():
        out = F.when(value == name, F.lit(number)).otherwise(out)
    return out


def with_presence(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """All columns of a plain table under the null rules, but for those that are set explicitly (``keep``)."""
    zero = {T.StringType: "", T.BooleanType: False, T.BinaryType: b"", T.ByteType: 0, T.ShortType: 0, T.IntegerType: 0, T.LongType: 0, T.FloatType: 0.0, T.DoubleType: 0.0}

    def rule(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if f.name in keep:
            return c
        if isinstance(f.dataType, T.MapType):
            return entries(c).alias(f.name)
        if isinstance(f.dataType, T.ArrayType):
            return absent_if_empty(c).alias(f.name)
        if isinstance(f.dataType, T.DecimalType):
            return absent_if(c, 0).alias(f.name)
        return absent_if(c, zero[type(f.dataType)]).alias(f.name) if type(f.dataType) in zero else c

    return df.select(*map(rule, df.schema.fields))
