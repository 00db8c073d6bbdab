"""What a run says while it goes on: rows and their rate by micro-batch, and the manifest's totals with rates between samples."""

from __future__ import annotations

import logging
import time

from pyspark.sql import SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

from rangelake.operators.stats import totals
from rangelake.plans import sink
from rangelake.sources.store import Store
from rangelake.streaming.metrics import Gauges

log = logging.getLogger("rangelake")
COUNTERS = ("files", "rows", "bytes")


class Samples:
    """Totals of a store's manifest, and each counter's change a second since the sample before; also set as gauges."""

    def __init__(self, spark: SparkSession, url: str, gauges: Gauges | None = None) -> None:
        self.spark, self.store, self.gauges = spark, Store(spark, url), gauges or Gauges()
        self.before: dict[str, tuple[float, dict[str, int]]] = {}

    def take(self, at: float | None = None) -> list[dict]:
        at = time.time() if at is None else at
        out = []
        for r in totals(sink.manifest(self.spark, self.store)).orderBy("table").collect():
            row = r.asDict()
            then, counts = self.before.get(row["table"], (at, {}))
            for c in COUNTERS:
                row[f"{c}_per_sec"] = (row[c] - counts[c]) / (at - then) if counts and at > then else 0.0
            self.before[row["table"]] = (at, {c: row[c] for c in COUNTERS})
            for c in (*COUNTERS, *[f"{c}_per_sec" for c in COUNTERS], "active_range_lo", "last_rows", "last_bytes", "last_seconds", "last_sealed_at"):
                self.gauges.set(f"rangelake_{c}", row[c], table=row["table"])
            out.append(row)
        return out

    def report(self) -> None:
        for r in self.take():
            log.info("table %r: %d files, %d rows (%.1f/s), %d bytes (%.0f/s), active range %d, last file %s (%d rows, %d bytes, %.3f s)", r["table"], r["files"], r["rows"], r["rows_per_sec"], r["bytes"], r["bytes_per_sec"], r["active_range_lo"], r["last_file"], r["last_rows"], r["last_bytes"], r["last_seconds"])


class Progress(StreamingQueryListener):
    """Logs each micro-batch, and sets its gauges."""

    def __init__(self, gauges: Gauges | None = None) -> None:
        super().__init__()
        self.gauges, self.envelopes = gauges or Gauges(), 0

    def onQueryStarted(self, event) -> None:  # noqa: N802
        log.info("stream %s started", event.id)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self.envelopes += p.numInputRows
        for name, value in (("batch", p.batchId), ("envelopes", self.envelopes), ("envelopes_per_sec", p.processedRowsPerSecond or 0.0), ("batch_milliseconds", p.batchDuration)):
            self.gauges.set(f"rangelake_stream_{name}", value)
        log.info("batch %d: %d rows, %.1f rows/s in, %.1f rows/s processed, %d ms", p.batchId, p.numInputRows, p.inputRowsPerSecond or 0.0, p.processedRowsPerSecond or 0.0, p.batchDuration)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        log.info("stream %s ended%s", event.id, f": {event.exception}" if event.exception else "")
