"""Token-ID output: texts as Simple-8b segments in ascending doc_id order, and back.

Documents are range-partitioned by doc_id, encoded, closed by the end id, and written as a Parquet table of segments:
``part`` and ``seq`` (together ascending in doc_id), the ids and lengths of the segment's documents, and the segment's
bytes. Parquet is the container because Spark alone can write to any store that the cluster uses. A document's place
among all ids is the sum over the parts before it (one number a part) plus its place inside its part.

Defined cases: a null or empty text is the end id alone. A null doc_id comes first; rows that repeat a doc_id are ordered
by text. An empty table gives no segments. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from rangelake.llm import simple8b
from rangelake.llm.encoder import AT_ONCE, END, encoder
from rangelake.llm.shared import ids_crc32, shared_folder, steps

VOCABULARY = "byte_bpe_50k.json"
#: Ids in a segment, about; a longer document is a segment of its own.
SEGMENT = 1 << 18

SCHEMA = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("seq", T.IntegerType()),
        T.StructField("begin", T.LongType()),
        T.StructField("n_ids", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("lengths", T.ArrayType(T.LongType())),
        T.StructField("segment", T.BinaryType()),
    ]
)


def _segments(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    part, seq, begin = TaskContext.get().partitionId(), 0, 0
    held: list[tuple[int | None, bytes]] = []
    size = 0

    def close() -> pa.RecordBatch:
        ids = np.frombuffer(b"".join(b for _, b in held), "<u4")
        lengths = [len(b) // 4 for _, b in held]
        columns = [[part], [seq], [begin], [len(ids)], [[d for d, _ in held]], [lengths], [simple8b.encode(ids)]]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], SCHEMA.names)

    for batch in steps(batches, most=AT_ONCE):
        texts = [t or "" for t in batch.column("text").to_pylist()]
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder(vocabulary).encode(texts), strict=True):
            held.append((doc_id, ids + END))
            size += len(ids) // 4 + 1
            if size >= SEGMENT:
                yield close()
                seq, begin, held, size = seq + 1, begin + size, [], 0
    if held:
        yield close()


def write_tokens(docs: DataFrame, path: str, vocabulary: str = VOCABULARY) -> None:
    """Writes the table of segments to ``path``."""
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(lambda b: _segments(b, vocabulary), SCHEMA).write.parquet(path)


def _documents(batches: Iterator[pa.RecordBatch], with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = simple8b.decode(row["segment"]).astype("<u4")
            ends = np.cumsum(row["lengths"])
            begins = ends - row["lengths"]
            own = [ids[a:b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
            columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(begins + row["begin"] + row["before"], pa.int64()), pa.array(row["lengths"], pa.int64()), pa.array([ids_crc32(x.tobytes()) for x in own], pa.int64())]
            names = ["doc_id", "start", "n_tokens", "ids_crc32"]
            if with_ids:
                columns.append(pa.array([x.tolist() for x in own], pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32, and on demand ids."""
    segments = spark.read.schema(SCHEMA).parquet(path)
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = segments.join(F.broadcast(parts.select("part", before.cast("long").alias("before"))), "part")  # a row for each writing task
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return placed.select("begin", "before", "doc_ids", "lengths", "segment").mapInArrow(lambda b: _documents(b, with_ids), schema)


def token_output(docs: DataFrame, vocabulary: str = VOCABULARY, path: str | None = None) -> DataFrame:
    """Writes the files, and reads each document's place and checksum back from them."""
    path = path or f"{shared_folder(docs.sparkSession)}/tokens"
    write_tokens(docs, path, vocabulary)
    return read_tokens(docs.sparkSession, path)
