"""Range files: one Parquet file per table and range, under the range's name, and a manifest of what is sealed.

Rows are filed by their own block. The decoded rows are kept in a staging folder, so they are decoded once; Spark then
writes each range in one task (sorted by block and ordinal), and the file is renamed. Empty ranges get a copy of one file
that has the schema alone, never in place of a file that is there. The manifest only grows, a part for each run, and is
written last, so a run that stops before can be repeated; of a range that was sealed again its last row counts.

A batch run that meets a range that has a file already goes on with it if all its blocks are behind those of the file,
and writes it anew if its blocks are the same; blocks that overlap otherwise are refused, before a file is changed.
"""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rangelake.functions.ranges import range_lo
from rangelake.operators.backfill import gaps
from rangelake.options import Options, codec
from rangelake.sources.store import Store

MANIFEST = "_manifest"
MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("range_lo", T.LongType()),
        T.StructField("range_hi", T.LongType()),
        T.StructField("file", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("sealed_at", T.DoubleType()),
        T.StructField("seconds", T.DoubleType()),  # that moving the file took
        T.StructField("settled", T.BooleanType()),  # no undo reaches it any more
        T.StructField("first_block", T.LongType()),
        T.StructField("last_block", T.LongType()),
        T.StructField("blocks", T.LongType()),
        T.StructField("block_hash", T.LongType()),  # of the distinct blocks that have rows
    ]
)
#: Files that are moved or copied at once.
RENAMES = 8


def name_of(lo: int, hi: int, pad: int) -> str:
    return f"{lo:0{pad}d}-{hi:0{pad}d}.parquet"


def with_range(df: DataFrame, options: Options, block: str = "block_number") -> DataFrame:
    """Adds range_lo; blocks at or above the stop block, which no range holds, are left out."""
    if options.stop_block is not None:
        df = df.filter(F.col(block) < options.stop_block)
    return df.withColumn("range_lo", range_lo(F.col(block), options.partition_size, options.start_block))


def manifest(spark: SparkSession, store: Store) -> DataFrame:
    if not store.exists(MANIFEST):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{store.url}/{MANIFEST}")


def latest(rows: DataFrame) -> DataFrame:
    """Of a manifest, the last row of each table and range."""
    columns = [f.name for f in MANIFEST_SCHEMA.fields]
    return rows.groupBy("table", "range_lo").agg(F.max_by(F.struct(*columns), F.col("sealed_at")).alias("row")).select("row.*")


def _hi(lo: int, options: Options) -> int:
    hi = lo + options.partition_size
    return hi if options.stop_block is None else min(hi, options.stop_block)


def _target(table: str, lo: int, options: Options) -> str:
    return (f"{table}/" if table else "") + name_of(lo, _hi(lo, options), options.pad_width)


def _staging(options: Options, turn: str) -> str:
    return f"{options.tmp_dir.strip('/') or '_staging'}/{turn}"


def _seal(store: Store, staging: str, table: str, ranges: list, options: Options, settled: bool) -> list[tuple]:
    """Moves each range's file to its place; gives the manifest rows. ranges: rows of what each range holds."""

    def one(r) -> tuple:
        lo, began = r["range_lo"], time.time()
        parts = [f for f in store.list(f"{staging}/range_lo={lo}") if f.startswith("part-")]
        target = _target(table, lo, options)
        # only with a limit of rows or bytes there are several: later parts are numbered
        names = [target] + [target.removesuffix(".parquet") + f".{k}.parquet" for k in range(1, len(parts))]
        for part, name in zip(parts, names, strict=True):
            store.replace(f"{staging}/range_lo={lo}/{part}", name)
        k = len(parts)
        while store.exists(more := target.removesuffix(".parquet") + f".{k}.parquet"):  # of an earlier, longer seal
            store.delete(more)
            k += 1
        now = time.time()
        return (table, lo, _hi(lo, options), target, r["n"], sum(store.size(n) for n in names), now, now - began, settled, r["first"], r["last"], r["blocks"], r["hash"])

    with ThreadPoolExecutor(RENAMES) as pool:
        return list(pool.map(one, ranges))


def _most(store: Store, staged: str, n: int, options: Options) -> int:
    """Rows that a file takes at most by ``max_records_per_file``, and by ``target_file_bytes`` at the size that the ``n`` staged
    rows have; 0: no limit."""
    limits = [options.max_records_per_file]
    if options.target_file_bytes and n:
        size = sum(store.size(f"{staged}/{f}") for f in store.list(staged) if f.startswith("part-"))
        limits.append(max(1, options.target_file_bytes * n // max(1, size)))
    return min((x for x in limits if x), default=0)


def _held(rows: DataFrame) -> list:
    """What each range of ``rows`` holds: rows, and its distinct blocks."""
    per_block = rows.groupBy("range_lo", "block_number").agg(F.count("*").alias("n"))
    held = per_block.groupBy("range_lo").agg(
        F.sum("n").alias("n"), F.min("block_number").alias("first"), F.max("block_number").alias("last"), F.count("*").alias("blocks"), F.expr("bit_xor(xxhash64(block_number))").alias("hash")
    )
    return held.orderBy("range_lo").collect()


def _continued(spark: SparkSession, store: Store, table: str, rows: DataFrame, held: list, before: dict, shown: T.StructType, options: Options) -> tuple[DataFrame, list]:
    """``rows`` behind those of the files that they go on with, and what the ranges then hold."""
    out = []
    for r in held:
        old = before.get(r["range_lo"])
        if old is None or not old["n_rows"] or (old["blocks"], old["block_hash"]) == (r["blocks"], r["hash"]):
            out.append(r.asDict())
            continue
        if r["first"] <= old["last_block"]:
            raise ValueError(f"{old['file']} holds blocks {old['first_block']} to {old['last_block']}; blocks from {r['first']} on can't be added to it")
        target, files, k = f"{store.url}/{old['file']}", [f"{store.url}/{old['file']}"], 1
        while store.exists(f"{old['file'].removesuffix('.parquet')}.{k}.parquet"):
            files.append(f"{target.removesuffix('.parquet')}.{k}.parquet")
            k += 1
        kept = spark.read.schema(shown).parquet(*files).withColumn("_place", F.monotonically_increasing_id()).withColumn("range_lo", F.lit(r["range_lo"]).cast("long"))
        for c in rows.columns:
            if c not in kept.columns:
                kept = kept.withColumn(c, F.lit(-1 if c in ("block_number", "ordinal") else None).cast(rows.schema[c].dataType))
        rows = rows.unionByName(kept.select(*rows.columns))
        out.append({"range_lo": r["range_lo"], "n": r["n"] + old["n_rows"], "first": old["first_block"], "last": r["last"], "blocks": r["blocks"] + old["blocks"], "hash": r["hash"] ^ old["block_hash"]})
    return rows, out


def write_ranges(rows: DataFrame, held: list, store: Store, table: str, options: Options, turn: str, order: tuple[str, ...], hidden: tuple[str, ...], settled: bool, most: int = 0) -> list[tuple]:
    """Writes ``rows`` (with range_lo, and _place as the last thing to sort by) as range files of ``table``. ``most``: rows a
    file takes at most, if not 0."""
    if not held:
        return []
    staging = f"{_staging(options, turn)}/{table or '_main'}"
    sorted_ = rows.repartition("range_lo").sortWithinPartitions("range_lo", *order, "_place")
    sorted_.drop("_place", *hidden).write.options(**options.writer() | ({"maxRecordsPerFile": str(most)} if most else {})).partitionBy("range_lo").parquet(f"{store.url}/{staging}")
    return _seal(store, staging, table, held, options, settled)


def write_empty(spark: SparkSession, store: Store, table: str, schema: T.StructType, ranges: list[int], options: Options, turn: str, settled: bool = True, over: bool = False) -> list[tuple]:
    """A file with the schema alone for each range: written once, and copied. Files that are there stay, but with ``over``."""
    if not ranges:
        return []
    staging = f"{_staging(options, turn)}/_empty/{table or '_main'}"
    spark.createDataFrame([], schema).coalesce(1).write.options(**options.writer()).parquet(f"{store.url}/{staging}")
    data = store.read(f"{staging}/{next(f for f in store.list(staging) if f.startswith('part-'))}")

    def one(lo: int) -> tuple | None:
        target, began = _target(table, lo, options), time.time()
        if not over and store.exists(target):
            return None
        if over:
            store.write(f"{staging}/range_lo={lo}", data)
            store.replace(f"{staging}/range_lo={lo}", target)
        else:
            store.write(target, data)
        now = time.time()
        return (table, lo, _hi(lo, options), target, 0, len(data), now, now - began, settled, None, None, 0, 0)

    with ThreadPoolExecutor(RENAMES) as pool:
        return [r for r in pool.map(one, ranges) if r is not None]


def record(spark: SparkSession, store: Store, rows: list[tuple], turn: str) -> None:
    if rows:
        spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.parquet(f"{store.url}/{MANIFEST}/{turn}")


def write_tables(tables: dict[str, DataFrame], store: Store, options: Options, turn: str | None = None, order: tuple[str, ...] = ("block_number",), hidden: tuple[str, ...] = (), settled: bool = True, anew: list[int] | None = None) -> list[tuple]:
    """Range files of all tables, the empty ones that the options ask for, and their manifest rows.

    ``anew``: ranges whose files are replaced by what the tables hold of them; else files are gone on with.
    """
    turn = f"{turn or 'batch'}-{uuid.uuid4().hex}"
    out: list[tuple] = []
    spark = next(iter(tables.values())).sparkSession
    known = latest(manifest(spark, store)).collect()  # a row a file
    plans = []
    for table, df in tables.items():  # what a run may not do shows before any file changes
        before = {r["range_lo"]: r for r in known if r["table"] == table}
        shown = T.StructType([f for f in df.schema.fields if f.name not in hidden])
        staged = f"{_staging(options, turn)}/_rows/{table or '_main'}"
        with_range(df, options).withColumn("_place", F.lit(0).cast("long")).write.option("compression", codec(options.compression)).parquet(f"{store.url}/{staged}")
        rows = spark.read.parquet(f"{store.url}/{staged}")
        held = _held(rows)
        most = _most(store, staged, sum(r["n"] for r in held), options)
        if anew is None:
            rows, held = _continued(spark, store, table, rows, held, before, shown, options)
        plans.append((table, before, shown, rows, held, most))
    for table, before, shown, rows, held, most in plans:
        sealed = write_ranges(rows, held, store, table, options, turn, order, hidden, settled, most)
        now = {r[1] for r in sealed}
        gone = [lo for lo in anew or () if lo not in now and lo in before and before[lo]["n_rows"]]
        sealed += write_empty(spark, store, table, shown, gone, options, f"{turn}/gone", settled, True)
        if options.fill_gaps != "none":
            done = spark.createDataFrame([(lo,) for lo in {*before, *now}], "range_lo long")
            missing = [r["range_lo"] for r in gaps(spark, done, options.start_block, options.partition_size, options.stop_block, options.fill_gaps).orderBy("range_lo").collect()]
            sealed += write_empty(spark, store, table, shown, missing, options, turn)
        out += sealed
    record(spark, store, out, turn)
    store.delete(_staging(options, turn))
    return out


def shape_tables(decoded: DataFrame, options: Options, maps: tuple[str, ...] = ()) -> tuple[dict[str, DataFrame], tuple[str, ...], tuple[str, ...]]:
    """Tables of decoded blocks, how their rows are sorted, and which columns are not written.

    Without explode: the main table, ``''``. With it: one table a root list, and no main table.
    """
    from rangelake.operators.explode import explode_table, root_lists

    if not options.explode:
        hidden = () if options.with_block_columns else tuple(c for c in ("block_number", "block_id") if c in decoded.columns)
        return {"": decoded}, ("block_number",), hidden
    lists = [n for n in root_lists(decoded, maps)]
    if not lists:
        raise ValueError("the message has no root list, so explode would write nothing")
    tables = {n: explode_table(decoded, n, "block_number", options.explode_scalar_compat) for n in lists}
    return tables, ("block_number", "ordinal"), () if options.with_lineage else ("block_number", "ordinal")


def write_blocks(blocks: DataFrame, url: str, descriptor_set: bytes, options: Options, turn: str | None = None, settled: bool = True, anew: list[int] | None = None) -> list[tuple]:
    """A finished set of blocks to range files; gives the manifest rows. ``anew``: see ``write_tables``."""
    from rangelake.functions.types import is_map, load_descriptor
    from rangelake.operators.decode import ERROR, decode
    from rangelake.sources.envelope import within

    store = Store(blocks.sparkSession, url)
    carry = ("block_number", "block_id") if options.with_block_columns and not options.explode else ("block_number",)
    chosen = within(blocks.filter("kind IS NULL OR kind = 'data'") if "kind" in blocks.columns else blocks, 0, options.stop_block)
    message = load_descriptor(descriptor_set, options.message)
    maps = tuple(f.name for f in message.fields if is_map(f))

    def decoded(fields: list[str] | None) -> DataFrame:
        rows = decode(chosen, descriptor_set, options.message, fields, options.mode, options.max_depth, options.wkt_timestamps, carry)
        return rows.filter(F.col(ERROR).isNull()).drop(ERROR) if options.mode == "PERMISSIVE" else rows

    if options.mode == "PERMISSIVE":
        parsed = decode(chosen, descriptor_set, options.message, [], options.mode, options.max_depth, options.wkt_timestamps, ("block_number",))
        bad = parsed.filter(F.col(ERROR).isNotNull()).select("block_number", F.col(ERROR).alias("error"))
        bad.write.mode("append").parquet(f"{store.url}/_quarantine/{turn or 'batch'}")
    tables, order, hidden = shape_tables(decoded(None), options, maps)
    if options.explode:  # of a list's table nothing else is decoded
        tables = {n: shape_tables(decoded([n]), options)[0][n] for n in tables}
    return write_tables(tables, store, options, turn, order, hidden, settled, anew)
