"""Storage through Hadoop's FileSystem: URL rules, the probe, renames."""

from __future__ import annotations

import os
import time
from urllib.parse import urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def normalise_url(url: str, prefix: str = "") -> str:
    """A local path or file URL as an absolute ``file://`` URL; other schemes stay. The prefix is joined."""
    if not url:
        raise ValueError("the store URL is empty")
    parsed = urlparse(url)
    if parsed.scheme in ("", "file"):
        path = url.removeprefix("file://") if parsed.scheme else url
        url = "file://" + os.path.abspath(path)
    if not prefix:
        return url
    head, mark, query = url.partition("?")
    return f"{head.rstrip('/')}/{prefix.strip('/')}{mark}{query}"


class Store:
    """A folder of any file system that Spark's Hadoop client reaches."""

    def __init__(self, spark: SparkSession, url: str) -> None:
        self.url = url.partition("?")[0].rstrip("/")
        self.jvm, self.gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.url}/{name}" if name else self.url)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def size(self, name: str) -> int:
        return self.fs.getFileStatus(self.path(name)).getLen()

    def list(self, name: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(name))) if self.exists(name) else []

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def write(self, name: str, data: bytes) -> None:
        out = self.fs.create(self.path(name), True)
        try:
            out.write(data)
        finally:
            out.close()

    def read(self, name: str) -> bytes:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def replace(self, source: str, target: str) -> None:
        """Renames a file; one that is there already gives way, in one step where the file system can do that."""
        to = self.path(target)
        self.fs.mkdirs(to.getParent())
        if not self.fs.exists(to):
            if not self.fs.rename(self.path(source), to):
                raise OSError(f"{source} could not be renamed to {target}")
            return
        hadoop = self.jvm.org.apache.hadoop.fs
        try:
            context = hadoop.FileContext.getFileContext(self.fs.getUri(), self.conf)
        except Py4JJavaError:  # a file system without that interface
            self.fs.delete(to, False)
            if not self.fs.rename(self.path(source), to):
                raise OSError(f"{source} could not be renamed to {target}") from None
            return
        options = self.gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
        options[0] = getattr(hadoop, "Options$Rename").OVERWRITE
        context.rename(self.path(source), to, options)


def probe(spark: SparkSession, url: str, prefix: str = "") -> str:
    """Writes, reads, compares and deletes a small object; gives its name."""
    store = Store(spark, normalise_url(url, prefix))
    name = f".rangelake-setup/probe-{time.time_ns()}"
    store.write(name, b"ok")
    try:
        if store.read(name) != b"ok":
            raise OSError(f"{name} does not read as written")
    finally:
        store.delete(name)
    return name
