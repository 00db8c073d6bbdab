"""Block-range arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def check_bounds(size: int, start: int = 0, end: int | None = None) -> None:
    if size <= 0:
        raise ValueError(f"range size must be positive, not {size}")
    if end is not None and end <= start:
        raise ValueError(f"end {end} must be above start {start}")


def range_lo(block: Column, size: int, start: int = 0) -> Column:
    """Lower bound of the range that holds ``block``; blocks below ``start`` count as ``start``."""
    check_bounds(size, start)
    above = F.greatest(block, F.lit(start)) - F.lit(start)
    return (F.lit(start) + above - above % F.lit(size)).cast("long")


def range_hi(lo: Column, size: int, end: int | None = None) -> Column:
    """Upper bound, exclusive; the last range may be short."""
    hi = lo + F.lit(size)
    return (hi if end is None else F.least(hi, F.lit(end))).cast("long")


def file_name(lo: Column, hi: Column, pad: int = 10) -> Column:
    """``<lo>-<hi>.parquet``, zero-padded, so that names sort as numbers do."""
    return F.format_string(f"%0{pad}d-%0{pad}d.parquet", lo, hi)
