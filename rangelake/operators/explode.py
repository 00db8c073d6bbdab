"""Root lists as tables of their own, one row an element."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def root_lists(df: DataFrame, maps: tuple[str, ...] = ()) -> list[str]:
    """Array columns, but for those that are maps in list form."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType) and f.name not in maps]


def explode_table(df: DataFrame, field: str, lineage: str | None = None, scalar_compat: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """The elements of ``field``: structs as their fields, scalars as one column of the field's name.

    NULL and empty lists give no rows. ``lineage`` names the column that tells the parent; it comes first, followed by
    the element's ``ordinal``. ``keep`` are other columns to carry in front. ``scalar_compat`` gives scalars as NULL.
    """
    kind = df.schema[field].dataType
    if not isinstance(kind, T.ArrayType):
        raise ValueError(f"{field} is not a list")
    front = [F.col(c) for c in dict.fromkeys([*keep, *([lineage] if lineage else [])])]
    if lineage:
        rows = df.select(*front, F.posexplode(field).alias("ordinal", "_element"))
        front = [*front, F.col("ordinal")]
    else:
        rows = df.select(*front, F.explode(field).alias("_element"))
    if isinstance(kind.elementType, T.StructType):
        return rows.select(*front, *[F.col("_element").getField(n).alias(n) for n in kind.elementType.names])
    value = F.lit(None).cast(kind.elementType) if scalar_compat else F.col("_element")
    return rows.select(*front, value.alias(field))
