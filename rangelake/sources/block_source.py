"""``rangelake_blocks``: a Python data source that serves a directory of envelope files, as a table or as a stream.

Options: ``path``, ``files_per_batch`` (0: all that there are). A stream's offset is the number of files in name order,
so files must be added under ascending names. It shows how a live endpoint plugs in; for files alone,
``sources.envelope`` reads them inside the JVM.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from rangelake.sources.envelope import ENVELOPE


def _files(path: str) -> list[str]:
    folder = urlparse(path).path
    return sorted(os.path.join(folder, f) for f in os.listdir(folder) if f.endswith(".parquet"))


class _File(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


def _rows(partition: _File) -> Iterator:
    columns = [f.name for f in ENVELOPE.fields]
    for batch in pq.ParquetFile(partition.path).iter_batches(columns=columns):
        yield batch.select(columns)


class _Reader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self) -> list[_File]:
        return [_File(f) for f in _files(self.path)]

    def read(self, partition: _File) -> Iterator:
        return _rows(partition)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, path: str, per_batch: int) -> None:
        self.path, self.per_batch, self.served = path, per_batch, 0

    def initialOffset(self) -> dict:  # noqa: N802
        return {"files": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        there = len(_files(self.path))
        self.served = min(there, self.served + self.per_batch) if self.per_batch else there
        return {"files": self.served}

    def partitions(self, start: dict, end: dict) -> list[_File]:
        self.served = max(self.served, end["files"])
        return [_File(f) for f in _files(self.path)[start["files"] : end["files"]]]

    def read(self, partition: _File) -> Iterator:
        return _rows(partition)

    def commit(self, end: dict) -> None:
        pass


class BlockSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "rangelake_blocks"

    def schema(self) -> str:
        return ENVELOPE.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return _StreamReader(self.options["path"], int(self.options.get("files_per_batch", 0)))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BlockSource)
