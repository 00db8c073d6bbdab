"""``python -m rangelake.cli run|setup``: range files from envelopes, and a check of the store."""

from __future__ import annotations

import argparse
import logging
from dataclasses import fields

from pyspark.sql import SparkSession

from rangelake.options import Options, from_environment
from rangelake.plans import sink
from rangelake.sources.envelope import read_block_stream, read_blocks
from rangelake.sources.store import normalise_url, probe
from rangelake.streaming import run as streaming
from rangelake.streaming.metrics import Gauges, close, serve, threads
from rangelake.streaming.progress import Progress, Samples

log = logging.getLogger("rangelake")
#: Seconds between two reports of a stream.
SAMPLE_SECONDS = 30


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="rangelake", description=__doc__)
    out.add_argument("--debug", action="store_true", help="log at debug level, Spark's own messages included")
    out.add_argument("--metrics-listen-addr", default="localhost:9102", help="host:port of /metrics; empty: none")
    out.add_argument("--pprof-listen-addr", default="localhost:6060", help="host:port of /threads, the driver's stacks; empty: none")
    commands = out.add_subparsers(dest="command", required=True)
    setup = commands.add_parser("setup", help="write, read and delete a small object in the store")
    setup.add_argument("store_url")
    setup.add_argument("--output-prefix", default=None)
    run = commands.add_parser("run", help="write range files")
    run.add_argument("store_url")
    run.add_argument("blocks", help="folder of envelope files")
    run.add_argument("--descriptors", required=True, help="file of a serialised FileDescriptorSet")
    run.add_argument("--stream", action="store_true", help="follow the folder instead of reading it once")
    run.add_argument("--available-now", action="store_true", help="with --stream: end when all files are read")
    run.add_argument("--checkpoint", default=None, help="with --stream: where the cursor is kept")
    for f in fields(Options):
        run.add_argument("--" + f.name.replace("_", "-"), default=None)
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(levelname)s %(message)s")
    log.setLevel(logging.DEBUG if args.debug else logging.INFO)
    spark = spark or SparkSession.builder.appName("rangelake").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.debug:
        spark.sparkContext.setLogLevel("DEBUG")
    if args.command == "setup":
        log.info("store is writable: %s", probe(spark, args.store_url, args.output_prefix or ""))
        return 0
    gauges = Gauges()
    servers = [serve(args.metrics_listen_addr, {"/metrics": gauges.text}), serve(args.pprof_listen_addr, {"/threads": lambda: threads(spark)})]
    try:
        return write(spark, args, gauges)
    finally:
        for server in servers:
            close(server)


def write(spark: SparkSession, args: argparse.Namespace, gauges: Gauges) -> int:
    options = from_environment(**{f.name: v for f in fields(Options) if (v := getattr(args, f.name)) is not None})
    if not options.message:
        raise SystemExit("--message is required: the full name of the blocks' message")
    url = normalise_url(args.store_url, options.output_prefix)
    with open(args.descriptors, "rb") as f:
        descriptor_set = f.read()
    if not args.stream:
        rows = sink.write_blocks(read_blocks(spark, args.blocks), url, descriptor_set, options)
        log.info("%d files, %d rows, %d bytes", len(rows), sum(r[4] for r in rows), sum(r[5] for r in rows))
        Samples(spark, url, gauges).report()
        return 0
    stream = read_block_stream(spark, args.blocks, options.max_files_per_trigger)
    samples, listener = Samples(spark, url, gauges), Progress(gauges)
    spark.streams.addListener(listener)
    query, sealer = streaming.start(stream, url, descriptor_set, options, args.checkpoint or f"{url}/_checkpoint", args.available_now)
    try:
        while not query.awaitTermination(SAMPLE_SECONDS):
            samples.report()
    except KeyboardInterrupt:
        log.info("stopping")
    try:
        streaming.finish(query, sealer)
        samples.report()
    finally:
        spark.streams.removeListener(listener)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
