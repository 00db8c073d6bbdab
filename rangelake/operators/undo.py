"""Chain reorganisations: rows that a later undo covers go."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangelake.functions.ranges import range_lo


def undo_apply(rows: DataFrame, undos: DataFrame, size: int = 5000) -> DataFrame:
    """``rows`` without those for which an undo came later (seq) and whose block is above its last valid block.

    An undo is spread over the ranges from its last valid block to the highest block, so the two meet on equal ranges
    instead of every row against every undo.
    """
    top = rows.agg(F.max("block_number").alias("top"))
    spread = undos.select(F.col("seq").alias("undo_seq"), F.col("last_valid_block").alias("undo_to")).crossJoin(F.broadcast(top)).filter("top > undo_to")  # top is one row
    first = range_lo(F.greatest(F.col("undo_to") + 1, F.lit(0)), size)
    spread = spread.select("undo_seq", "undo_to", F.explode(F.sequence(first, range_lo(F.col("top"), size), F.lit(size))).alias("undo_lo"))
    # one row a range and last valid block is enough: the latest undo
    spread = spread.groupBy("undo_lo", "undo_to").agg(F.max("undo_seq").alias("undo_seq"))
    lo = range_lo(F.col("block_number"), size)
    return rows.join(spread, (lo == F.col("undo_lo")) & (F.col("undo_seq") > F.col("seq")) & (F.col("undo_to") < F.col("block_number")), "left_anti")
