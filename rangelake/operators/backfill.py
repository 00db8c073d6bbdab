"""Ranges that have no file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rangelake.functions.ranges import check_bounds, range_hi


def expected_ranges(spark: SparkSession, start: int, until: int, size: int, end: int | None = None) -> DataFrame:
    """range_lo and range_hi of all ranges from start up to ``until`` (exclusive)."""
    check_bounds(size, start)
    n = max(0, -(-(until - start) // size))
    lo = (F.lit(start) + F.col("id") * size).cast("long")
    return spark.range(n).select(lo.alias("range_lo"), range_hi(lo, size, end).alias("range_hi"))


def missing_ranges(expected: DataFrame, done: DataFrame) -> DataFrame:
    """Expected ranges that ``done`` (range_lo) lacks."""
    return expected.join(done.select("range_lo").distinct(), "range_lo", "left_anti").select("range_lo", "range_hi")


def gaps(spark: SparkSession, done: DataFrame, start: int, size: int, end: int | None = None, fill: str = "leading") -> DataFrame:
    """Ranges to write as empty files: before the first that has data (leading), or also between and behind (all)."""
    first, last = done.agg(F.min("range_lo"), F.max("range_lo")).first()
    if first is None or fill == "none":
        return expected_ranges(spark, start, start, size, end)
    until = first if fill == "leading" else max(last + size, end or 0)
    return missing_ranges(expected_ranges(spark, start, until, size, end), done)
