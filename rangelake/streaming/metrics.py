"""Two small HTTP servers of the driver: gauges in Prometheus' text format, and what its threads are doing."""

from __future__ import annotations

import logging
import sys
import threading
import traceback
from collections.abc import Callable
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql import SparkSession

log = logging.getLogger("rangelake")


class Gauges:
    """Values by name and labels; safe to set and to read from several threads."""

    def __init__(self) -> None:
        self._values: dict[str, dict[tuple[tuple[str, str], ...], float]] = {}
        self._lock = threading.Lock()

    def set(self, name: str, value: float, **labels: str) -> None:
        with self._lock:
            self._values.setdefault(name, {})[tuple(sorted(labels.items()))] = float(value)

    def text(self) -> str:
        with self._lock:
            held = {name: dict(values) for name, values in self._values.items()}
        lines = []
        for name, values in sorted(held.items()):
            lines.append(f"# TYPE {name} gauge")
            for labels, value in sorted(values.items()):
                shown = ",".join(f'{k}="{_escaped(v)}"' for k, v in labels)
                lines.append(f"{name}{{{shown}}} {value!r}" if shown else f"{name} {value!r}")
        return "".join(line + "\n" for line in lines)


def _escaped(label: str) -> str:
    return label.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n")


def threads(spark: SparkSession) -> str:
    """The stacks of the driver's Python and JVM threads."""
    names = {t.ident: t.name for t in threading.enumerate()}
    own = [f"python {names.get(k, k)}\n{''.join(traceback.format_stack(frame))}" for k, frame in sys._current_frames().items()]
    beans = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getThreadMXBean()
    return "\n".join([*own, *[f"jvm {info.toString()}" for info in beans.dumpAllThreads(False, False) if info is not None]])


def serve(address: str, pages: dict[str, Callable[[], str]]) -> ThreadingHTTPServer | None:
    """A server of these pages at ``host:port``, in a thread of its own; port 0 is any free one. Without an address, or
    where it can't be had, none: a run goes on without its metrics."""
    if not address:
        return None

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self) -> None:  # noqa: N802
            page = pages.get(self.path.split("?")[0])
            status, body = (404, "no such page\n") if page is None else (200, page())
            data = body.encode()
            self.send_response(status)
            self.send_header("Content-Type", "text/plain; version=0.0.4; charset=utf-8")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *args) -> None:
            log.debug("http: %s", args[0] % args[1:])

    host, colon, port = address.rpartition(":")
    if not colon or not port.isdigit():
        raise ValueError(f"an address to listen at is host:port, not {address!r}")
    try:
        server = ThreadingHTTPServer((host.strip("[]"), int(port)), Handler)
    except (OSError, OverflowError) as e:
        log.warning("nothing is served at %s: %s", address, e)
        return None
    server.daemon_threads = True
    threading.Thread(target=server.serve_forever, name=f"serves {address}", daemon=True).start()
    return server


def close(server: ThreadingHTTPServer | None) -> None:
    if server is not None:
        server.shutdown()
        server.server_close()
