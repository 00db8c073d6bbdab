from __future__ import annotations

import glob
import urllib.error
import urllib.request
from types import SimpleNamespace

import pytest

from rangelake.operators.stats import totals
from rangelake.operators.undo import undo_apply
from rangelake.options import Options
from rangelake.plans import sink
from rangelake.sources.block_source import register
from rangelake.sources.envelope import ENVELOPE, read_block_stream
from rangelake.sources.store import Store
from rangelake.streaming import run as streaming
from rangelake.streaming.metrics import Gauges, close, serve, threads
from rangelake.streaming.progress import Progress, Samples
from tests.fixtures import data, descriptor_set, kind, roots, undo

SET = descriptor_set()
root = kind("Root")


def put(spark, path, *batches, first=0):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, ENVELOPE).coalesce(1).write.mode("append").parquet(f"{path}/part{first + i}")


def run(spark, source, out, options):
    stream = read_block_stream(spark, f"{source}/*", 1)
    query, sealer = streaming.start(stream, f"file://{out}", SET, options, f"{out}/_checkpoint", available_now=True)
    query.awaitTermination()
    return query, sealer


def values(spark, out, table=""):
    found = glob.glob(f"{out}/{table}/*.parquet" if table else f"{out}/*.parquet")
    return sorted((tuple(r) for r in spark.read.parquet(*found).select("n").collect()), key=lambda r: (r[0] is None, r[0])) if found else []


FORK = [data(1, 100, root(n=1), "a"), data(2, 101, root(n=2), "b"), data(3, 102, root(n=3), "c"), undo(4, 100), data(5, 101, root(n=20), "b2"), data(6, 102, root(n=30), "c2")]


def test_undo_apply(spark):
    df = spark.createDataFrame(FORK, ENVELOPE)
    blocks, undos = df.filter("kind = 'data'"), df.filter("kind = 'undo'").select("seq", "last_valid_block")
    assert sorted((r["block_number"], r["block_id"]) for r in undo_apply(blocks, undos, 10).collect()) == [(100, "a"), (101, "b2"), (102, "c2")]
    assert [r["block_id"] for r in undo_apply(blocks.filter("seq < 4"), undos, 10).collect()] == ["a"]
    assert undo_apply(blocks, undos.limit(0), 10).count() == 5


def test_stream_equals_batch(spark, tmp_path):
    rows = [data(i, b, root(n=b)) for i, b in enumerate(range(1, 50))]
    put(spark, tmp_path / "in", rows[:20], rows[20:21], rows[21:])
    options = Options(partition_size=10, message="t.Root", undo_buffer_size=5)
    query, sealer = run(spark, tmp_path / "in", tmp_path / "out", options)
    assert max(r["range_hi"] for r in sink.manifest(spark, Store(spark, f"file://{tmp_path}/out")).collect()) == 40
    streaming.finish(query, sealer)
    sink.write_blocks(spark.createDataFrame(rows, ENVELOPE), f"file://{tmp_path}/batch", SET, options)
    names = lambda p: sorted(f.rsplit("/", 1)[1] for f in glob.glob(f"{p}/*.parquet"))
    assert names(tmp_path / "out") == names(tmp_path / "batch")
    assert values(spark, tmp_path / "out") == values(spark, tmp_path / "batch") == [(b,) for b in range(1, 50)]


def test_restart(spark, tmp_path):
    rows = roots()
    options = Options(partition_size=1, start_block=10, message="t.Root")
    put(spark, tmp_path / "in", rows[:1])
    run(spark, tmp_path / "in", tmp_path / "out", options)
    put(spark, tmp_path / "in", rows[1:2], first=1)
    run(spark, tmp_path / "in", tmp_path / "out", options)
    put(spark, tmp_path / "in", rows[2:], first=2)
    query, sealer = run(spark, tmp_path / "in", tmp_path / "out", options)
    streaming.finish(query, sealer)
    spark.catalog.clearCache()
    assert len(glob.glob(f"{tmp_path}/out/*.parquet")) == 3
    assert sorted(map(str, values(spark, tmp_path / "out"))) == ["(1,)", "(2,)", "(None,)"]


def test_reorganisation(spark, tmp_path):
    put(spark, tmp_path / "in", FORK[:3], FORK[3:])
    query, sealer = run(spark, tmp_path / "in", tmp_path / "out", Options(partition_size=10, message="t.Root", undo_buffer_size=20))
    streaming.finish(query, sealer)
    assert values(spark, tmp_path / "out") == [(1,), (20,), (30,)]


def test_undo_below_sealed_files(spark, tmp_path):
    put(spark, tmp_path / "in", [data(i, i, root(n=i)) for i in range(1, 40)], [undo(99, 5)])
    with pytest.raises(Exception, match="reaches below"):
        query, sealer = run(spark, tmp_path / "in", tmp_path / "out", Options(partition_size=10, message="t.Root"))
        streaming.finish(query, sealer)


def test_late_rows_join_their_file(spark, tmp_path):
    put(spark, tmp_path / "in", [data(1, 1, root(n=1)), data(2, 25, root(n=25))], [data(3, 2, root(n=2))])
    query, sealer = run(spark, tmp_path / "in", tmp_path / "out", Options(partition_size=10, message="t.Root"))
    streaming.finish(query, sealer)
    assert values(spark, tmp_path / "out") == [(1,), (2,), (25,)]


def test_three_streams_that_end_keep_all_rows(spark, tmp_path):
    options = Options(partition_size=10, message="t.Root", fill_gaps="all", undo_buffer_size=3)
    for k in range(3):
        put(spark, tmp_path / "in", [data(b, b, root(n=b)) for b in range(1 + 15 * k, 16 + 15 * k)], first=k)
        streaming.finish(*run(spark, tmp_path / "in", tmp_path / "out", options))
    assert values(spark, tmp_path / "out") == [(b,) for b in range(1, 46)]


def test_undo_after_a_stop(spark, tmp_path):
    """What finish wrote ahead of the undo depth is written anew, also where the same number of rows, or none, is left."""
    options = Options(partition_size=10, message="t.Root", undo_buffer_size=50)
    put(spark, tmp_path / "in", [data(b, b, root(n=b)) for b in range(1, 31)])
    streaming.finish(*run(spark, tmp_path / "in", tmp_path / "out", options))
    assert len(values(spark, tmp_path / "out")) == 30
    put(spark, tmp_path / "in", [undo(31, 17), *[data(14 + b, b, root(n=100 + b), "new") for b in range(18, 21)]], first=1)
    streaming.finish(*run(spark, tmp_path / "in", tmp_path / "out", options))
    assert values(spark, tmp_path / "out") == [(b,) for b in range(1, 18)] + [(118,), (119,), (120,)]
    put(spark, tmp_path / "in", [data(40 + b, b, root(n=b)) for b in range(21, 90)], first=2)
    streaming.finish(*run(spark, tmp_path / "in", tmp_path / "out", options))
    assert len(values(spark, tmp_path / "out")) == 89
    total = totals(sink.manifest(spark, Store(spark, f"file://{tmp_path}/out"))).first()
    assert (total["files"], total["rows"]) == (9, 89)


def test_undone_lists_leave_their_tables(spark, tmp_path):
    options = Options(partition_size=10, message="t.Root", undo_buffer_size=50, explode=True)
    put(spark, tmp_path / "in", [data(1, 1, root(tags=["a", "b"])), data(2, 2, root(tags=["c"], items=[{"k": "x"}]))])
    streaming.finish(*run(spark, tmp_path / "in", tmp_path / "out", options))
    put(spark, tmp_path / "in", [undo(3, 1)], first=1)
    streaming.finish(*run(spark, tmp_path / "in", tmp_path / "out", options))
    rows = lambda table: [tuple(r) for r in spark.read.parquet(*glob.glob(f"{tmp_path}/out/{table}/*.parquet")).collect()]
    assert rows("tags") == [("a",), ("b",)] and rows("items") == []


def test_a_batch_reads_open_ranges_alone(spark, tmp_path, monkeypatch):
    seen = []
    staged = streaming.Sealer._staged
    monkeypatch.setattr(streaming.Sealer, "_staged", lambda self, ranges: seen.append(list(ranges)) or staged(self, ranges))
    put(spark, tmp_path / "in", *[[data(b, b, root(n=b)) for b in range(10 * k, 10 * k + 10)] for k in range(6)])
    streaming.finish(*run(spark, tmp_path / "in", tmp_path / "out", Options(partition_size=10, message="t.Root")))
    assert seen == [[10 * k] for k in range(6)] and len(values(spark, tmp_path / "out")) == 60


def test_samples(spark, tmp_path):
    samples = Samples(spark, f"file://{tmp_path}/out")
    assert samples.take(0.0) == []
    for k in range(2):
        sink.write_blocks(spark.createDataFrame([data(b, b, root(n=b)) for b in range(10 * k, 10 * k + 10)], ENVELOPE), f"file://{tmp_path}/out", SET, Options(partition_size=10, message="t.Root"))
        row = samples.take(5.0 * k)[0]
    assert (row["files"], row["rows"], row["rows_per_sec"], row["files_per_sec"], row["last_rows"]) == (2, 20, 2.0, 0.2, 10) and row["last_seconds"] >= 0


def test_metrics_are_served(spark, tmp_path):
    gauges = Gauges()
    sink.write_blocks(spark.createDataFrame([data(b, b, root(n=b)) for b in range(10)], ENVELOPE), f"file://{tmp_path}/out", SET, Options(partition_size=10, message="t.Root"))
    Samples(spark, f"file://{tmp_path}/out", gauges).report()
    gauges.set("rangelake_odd", 1, table='a"b')
    listener = Progress(gauges)
    for k in range(2):
        listener.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(batchId=k, numInputRows=3, inputRowsPerSecond=None, processedRowsPerSecond=1.5, batchDuration=7)))
    server = serve("localhost:0", {"/metrics": gauges.text, "/threads": lambda: threads(spark)})
    try:
        base = f"http://localhost:{server.server_address[1]}"
        lines = urllib.request.urlopen(f"{base}/metrics").read().decode().splitlines()
        assert {'rangelake_rows{table=""} 10.0', 'rangelake_files{table=""} 1.0', 'rangelake_odd{table="a\\"b"} 1.0', "rangelake_stream_envelopes 6.0", "# TYPE rangelake_rows gauge"} <= set(lines)
        stacks = urllib.request.urlopen(f"{base}/threads").read().decode()
        assert "python MainThread" in stacks and "jvm " in stacks
        with pytest.raises(urllib.error.HTTPError):
            urllib.request.urlopen(f"{base}/other")
        assert serve(f"localhost:{server.server_address[1]}", {}) is None  # taken: the run goes on
    finally:
        close(server)
    assert serve("", {}) is None
    with pytest.raises(ValueError, match="host:port"):
        serve("localhost", {})


def test_python_source(spark, tmp_path):
    spark.createDataFrame(FORK, ENVELOPE).repartition(3).write.parquet(f"{tmp_path}/in")
    register(spark)
    assert spark.read.format("rangelake_blocks").option("path", f"{tmp_path}/in").load().count() == 6
    stream = spark.readStream.format("rangelake_blocks").option("path", f"{tmp_path}/in").option("files_per_batch", "1").load()
    query = stream.writeStream.format("memory").queryName("blocks").option("checkpointLocation", f"{tmp_path}/c").trigger(processingTime="1 second").start()
    try:
        query.processAllAvailable()
        assert spark.table("blocks").count() == 6
    finally:
        query.stop()
