"""Counters of a run, from its manifest: rows, files, bytes, the last upload, and rates between samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def totals(manifest: DataFrame) -> DataFrame:
    """Per table: files, rows, bytes, the active range and the last file, its rows, bytes and seconds. Of a file that was
    written several times, the last row counts."""
    last = manifest.groupBy("table", "file").agg(F.max_by(F.struct("range_lo", "n_rows", "bytes", "sealed_at", "seconds"), F.col("sealed_at")).alias("x")).select("table", "file", "x.*")
    newest = F.struct("sealed_at", "range_lo")
    return last.groupBy("table").agg(
        F.count("*").alias("files"), F.sum("n_rows").alias("rows"), F.sum("bytes").alias("bytes"), F.max("range_lo").alias("active_range_lo"),
        F.max_by("file", newest).alias("last_file"), F.max_by("n_rows", newest).alias("last_rows"), F.max_by("bytes", newest).alias("last_bytes"), F.max_by("seconds", newest).alias("last_seconds"),
        F.max("sealed_at").alias("last_sealed_at"),
    )


def rates(samples: DataFrame, key: str, at: str, counters: tuple[str, ...]) -> DataFrame:
    """Each counter's change a second since the sample before; 0 for the first, or if no time went by. ``at``: seconds."""
    before = Window.partitionBy(key).orderBy(at)
    dt = F.col(at) - F.lag(at).over(before)
    per = [F.when(dt > 0, (F.col(c) - F.lag(c).over(before)) / dt).otherwise(F.lit(0.0)).cast("double").alias(f"{c}_per_sec") for c in counters]
    return samples.select("*", *per)
