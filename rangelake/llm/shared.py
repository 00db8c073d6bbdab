"""What the operators share: the folder for cut lineage, id checksums, and batch helpers."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  binds pa.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rangelake.functions.scratch import scratch_folder

#: Bytes of text that one vectorised step works on; a single longer text is taken alone.
STEP_BYTES = 4 << 20
#: Freed bytes at the end of a task's heap that it keeps while it runs.
KEPT = 128 << 20


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which all executors share; removed when the JVM ends."""
    return scratch_folder(spark)


def cut(df: DataFrame, name: str, folder: str | None = None, by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage ends here, and lost executors cost nothing.
    ``by``: a column whose values get a folder each."""
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/{name}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(docs: DataFrame, dropped: DataFrame, marked: DataFrame, mark: Column) -> DataFrame:
    """``docs`` without the rows whose doc_id and ``mark`` (a function of the text) stand in ``dropped`` (doc_id, mark).

    Rows that repeat both stay once; they are brought down to one a task before the shuffle. Whether there are any is told
    by ``marked`` (doc_id, mark, of all rows), as bringing rows down sorts the texts once more in each task.
    """

    def key(mark: Column) -> Column:
        return F.concat_ws(":", mark, F.coalesce(F.col("doc_id").cast("string"), F.lit("")))

    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(key(mark).alias("key"), F.struct(*columns).alias("row"))
    if not marked.groupBy("doc_id", "mark").count().filter("count > 1").isEmpty():
        rows = rows.groupBy("key").agg(F.first("row").alias("row"))
    return rows.join(dropped.select(key(F.col("mark")).alias("key")).hint("merge"), "key", "left_anti").select("row.*")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def in_fold(ids: Column, modulus: int, remainder: int) -> Column:
    """crc32(id as text) mod modulus = remainder; a null id counts as the empty text."""
    return F.crc32(F.coalesce(ids.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def ids_crc32(ids: bytes) -> int:
    """Unsigned crc32 of ids laid out as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids) & 0xFFFFFFFF


def steps(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches, of about ``most`` bytes of ``column`` or one row."""
    for batch in batches:
        lengths = batch.column(column)
        sizes = pa.compute.binary_length(lengths).to_pylist()
        begin = held = 0
        for i, n in enumerate(sizes):
            if i > begin and held + (n or 0) > most:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += n or 0
        if begin < len(sizes):
            yield batch.slice(begin)
    give_back()


def keep_freed() -> None:
    """Arrays of up to 32 MB that a task frees and makes anew come from its heap. Else the system takes their pages back each
    time, and clears new ones, which costs numpy code on arrays of megabytes a quarter of its time. ``give_back`` ends it."""
    libc = ctypes.CDLL(None)
    if hasattr(libc, "mallopt"):  # glibc: M_MMAP_THRESHOLD, M_TRIM_THRESHOLD, M_TOP_PAD
        for setting, size in ((-3, 32 << 20), (-1, KEPT), (-2, KEPT // 16)):
            libc.mallopt(setting, size)


def give_back() -> None:
    """Freed memory goes back to the system at a task's end, as Spark keeps its Python workers for the tasks of other stages."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)
