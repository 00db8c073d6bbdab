"""The envelope: one row for each signal of a block stream, read as a table or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("block_number", T.LongType()),
        T.StructField("block_id", T.StringType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("cursor", T.StringType()),
        T.StructField("is_live", T.BooleanType()),
        T.StructField("last_valid_block", T.LongType()),
    ]
)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ENVELOPE).parquet(path)


def read_block_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 0) -> DataFrame:
    reader = spark.readStream.schema(ENVELOPE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def within(blocks: DataFrame, start: int = 0, stop: int | None = None) -> DataFrame:
    """Blocks from start up to stop, exclusive. Plain comparisons, so they reach the scan."""
    out = blocks.filter(F.col("block_number") >= start)
    return out if stop is None else out.filter(F.col("block_number") < stop)


def after_cursor(blocks: DataFrame, block: int) -> DataFrame:
    """Blocks behind the last one that a cursor covers."""
    return blocks.filter(F.col("block_number") > block)


def with_payload(blocks: DataFrame) -> DataFrame:
    return blocks.filter(F.col("payload").isNotNull())


def raw_table(blocks: DataFrame) -> DataFrame:
    """Block number, id and payload as they came; the number unsigned."""
    return with_payload(blocks).select(F.col("block_number").cast("decimal(20,0)").alias("block_number"), F.coalesce("block_id", F.lit("")).alias("block_id"), "payload")
