"""The stream: envelopes are staged by range as they come; ranges that no undo can reach any more are sealed.

A micro-batch overwrites its own folders in the ranges that it touches, so a batch that Spark repeats changes nothing. A
range is settled once its upper bound is at least ``undo_buffer_size`` blocks below the highest block: undone rows are
taken out, the rest is decoded once, and range files and manifest are written. An undo that reaches below what is settled
is an error. Spark's checkpoint is the cursor; it moves only after a batch is staged.

A batch looks at the open ranges and at those that it brings rows for, no others, so its cost doesn't grow with the
stream's age; what was staged for settled ranges stays, as late rows make their files anew. Whether a range is written
again is told by what it holds (a hash over its rows), not by how many rows. ``finish`` also writes ranges that an undo may
still reach; they stay open, and a later run writes them anew.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from rangelake.operators.undo import undo_apply
from rangelake.options import Options
from rangelake.plans import sink
from rangelake.sources.envelope import ENVELOPE
from rangelake.sources.store import Store

BLOCKS, UNDOS, STATE = "_stream/blocks", "_stream/undos", "_stream/state"
STAGED = T.StructType([*ENVELOPE.fields, T.StructField("range_lo", T.LongType()), T.StructField("batch", T.LongType())])


class Sealer:
    def __init__(self, spark: SparkSession, url: str, descriptor_set: bytes, options: Options) -> None:
        self.spark, self.url, self.descriptor_set, self.options = spark, url, descriptor_set, options
        self.store = Store(spark, url)

    def state(self) -> dict:
        """head: the highest block so far; settled: up to where files are settled; open: ranges behind that which have rows."""
        if self.store.exists(STATE):
            return json.loads(self.store.read(STATE))
        return {"head": None, "settled": None, "open": []}

    def _keep(self, state: dict) -> None:
        self.store.write(f"{STATE}.new", json.dumps(state).encode())
        self.store.replace(f"{STATE}.new", STATE)

    def _staged(self, ranges: list[int]) -> DataFrame:
        """What was staged for these ranges; no other folder is listed."""
        paths = [f"{self.store.url}/{BLOCKS}/range_lo={lo}" for lo in ranges if self.store.exists(f"{BLOCKS}/range_lo={lo}")]
        if not paths:
            return self.spark.createDataFrame([], STAGED)
        return self.spark.read.schema(STAGED).option("basePath", f"{self.store.url}/{BLOCKS}").parquet(*paths)

    def _undos(self) -> DataFrame:
        if not self.store.exists(UNDOS):
            return self.spark.createDataFrame([], "seq long, last_valid_block long")
        return self.spark.read.schema("seq long, last_valid_block long, batch long").parquet(f"{self.store.url}/{UNDOS}").select("seq", "last_valid_block")

    def stage(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch: into staging, then seal what is settled."""
        batch = batch.persist()
        try:
            blocks = sink.with_range(batch.filter("kind = 'data'"), self.options).withColumn("batch", F.lit(batch_id).cast("long"))
            brought = [r["range_lo"] for r in blocks.select("range_lo").distinct().orderBy("range_lo").collect()]
            for lo in brought:
                self.store.delete(f"{BLOCKS}/range_lo={lo}/batch={batch_id}")
            self.store.delete(f"{UNDOS}/batch={batch_id}")
            undos = batch.filter("kind = 'undo'").select("seq", "last_valid_block")
            undos.write.parquet(f"{self.store.url}/{UNDOS}/batch={batch_id}")
            if brought:
                blocks.write.mode("append").partitionBy("range_lo", "batch").parquet(f"{self.store.url}/{BLOCKS}")
            low = undos.agg(F.min("last_valid_block")).first()[0]
            top = blocks.agg(F.max("block_number")).first()[0]
        finally:
            batch.unpersist()
        state = self.state()
        if low is not None and state["settled"] is not None and low + 1 < state["settled"]:
            raise ValueError(f"an undo to block {low} reaches below block {state['settled']}, up to which files are settled")
        state["head"] = max((x for x in (state["head"], top) if x is not None), default=None)
        state["open"] = sorted({*state["open"], *brought})
        self._keep(state)
        self.seal(f"seal-{batch_id}")

    def _settled(self, lo: int, head: int) -> bool:
        hi = lo + self.options.partition_size
        return (hi if self.options.stop_block is None else min(hi, self.options.stop_block)) <= head + 1 - self.options.undo_buffer_size

    def seal(self, turn: str, everything: bool = False) -> list[tuple]:
        state = self.state()
        head = state["head"]
        if head is None:
            return []
        out: list[tuple] = []
        settled = [lo for lo in state["open"] if self._settled(lo, head)]
        for ranges, final in ((settled, True), ([lo for lo in state["open"] if lo not in settled] if everything else [], False)):
            if ranges:
                out += self._write(ranges, turn, final)
        if settled:
            state["settled"] = max(x for x in (state["settled"], max(settled) + self.options.partition_size) if x is not None)
            state["open"] = [lo for lo in state["open"] if lo not in settled]
            self._keep(state)
        return out

    def _write(self, ranges: list[int], turn: str, final: bool) -> list[tuple]:
        rows = undo_apply(self._staged(ranges), self._undos(), self.options.partition_size)
        digest = F.sum(F.xxhash64("seq", "block_number", "block_id", "payload").cast("decimal(38,0)"))
        now = {r["range_lo"]: f"{r['n']} {r['h']} {final}" for r in rows.groupBy("range_lo").agg(F.count("*").alias("n"), digest.alias("h")).collect()}
        # rows for a range that has a file: it is written anew, from all that was staged for it and is left
        changed = [lo for lo in ranges if self._seen(lo) != now.get(lo, f"0 None {final}")]
        if not changed:
            return []
        own = rows.filter(F.col("range_lo").isin(changed)).select(*ENVELOPE.fieldNames())
        out = sink.write_blocks(own, self.url, self.descriptor_set, self.options, turn, final, changed)
        for lo in changed:
            self.store.write(f"_stream/seen/{lo}", now.get(lo, f"0 None {final}").encode())
        return out

    def _seen(self, lo: int) -> str | None:
        """What the range's last seal saw."""
        mark = f"_stream/seen/{lo}"
        return self.store.read(mark).decode() if self.store.exists(mark) else None


def start(stream: DataFrame, url: str, descriptor_set: bytes, options: Options, checkpoint: str, available_now: bool = False) -> tuple[StreamingQuery, Sealer]:
    """Starts the run; ``finish`` ends it."""
    sealer = Sealer(stream.sparkSession, url, descriptor_set, options)
    writer = stream.writeStream.foreachBatch(sealer.stage).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=options.flush_interval)
    return writer.start(), sealer


def finish(query: StreamingQuery, sealer: Sealer) -> None:
    """Waits for what is there, stops, and writes the rest, unfinished last range included."""
    if query.isActive:
        query.processAllAvailable()
        query.stop()
    if query.exception() is not None:
        raise query.exception()
    sealer.seal("seal-close", everything=True)
