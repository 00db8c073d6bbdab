"""The engine's queries over the driver's tables, each beside the SQL that it is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rangelake.functions.presence import absent_if, absent_if_empty, entries, enum_number
from rangelake.functions.ranges import file_name, range_hi, range_lo
from rangelake.operators.backfill import expected_ranges, missing_ranges
from rangelake.operators.explode import explode_table
from rangelake.operators.stats import rates, totals
from rangelake.operators.undo import undo_apply
from rangelake.sources.envelope import after_cursor, raw_table, with_payload, within

#: Deliberately off the data's alignment, so that the lower bound clamps. Runs end behind the table's last block.
START, SIZE = 500, 700
#: The stop block of the query that shows bounds.
STOP = 14900
#: Blocks that have gaps: documents that have a label, filed into small ranges.
GAP_START, GAP_SIZE = 5, 4
ROW_GROUP = 300
#: Order numbers behind this one are what a resumed run reads.
CURSOR = 7321
#: Enums and reorganisations that the queries use.
STATUS = {"O": 1, "F": 2, "P": 3}
ROLES = {"system": 1, "user": 2, "assistant": 3}
UNDOS = ((5000, 4700), (5001, 4400), (9000, 8700))

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

#: What the SQL shares: an order's range, and a line's fields in an order that no two different lines share.
_LO = f"({START} + (greatest(o_orderkey, {START}) - {START}) // {SIZE} * {SIZE})"
_END = "(SELECT max(o_orderkey) + 1 FROM orders)"
_HI = f"least({_LO} + {SIZE}, {_END})"
_LINE = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
LINE = _LINE.split(", ")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return keep


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def end_of(blocks: DataFrame, column: str = "block_number") -> int:
    """The stop block behind the last block; at least one behind START."""
    last = blocks.agg(F.max(column)).first()[0]
    return max(START + 1, (last if last is not None else 0) + 1)


def order_blocks(spark: SparkSession, sf_dir: str, start: int = 0, end: int | None = None) -> DataFrame:
    """Orders as blocks inside the bounds."""
    return within(table(spark, sf_dir, "orders").withColumn("block_number", F.col("o_orderkey")), start, end)


def ranged(df: DataFrame) -> DataFrame:
    return df.withColumn("range_lo", range_lo(F.col("block_number"), SIZE, START))


def nested_orders(spark: SparkSession, sf_dir: str, in_order: bool = True) -> DataFrame:
    """Orders with their lines as a list, sorted if asked for; NULL where there are none. Lines are brought together by one shuffle of their key."""
    lines = F.collect_list(F.struct(*LINE))
    per_order = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg((F.array_sort(lines) if in_order else lines).alias("lines"))
    orders = table(spark, sf_dir, "orders")
    return orders.join(per_order, orders["o_orderkey"] == per_order["l_orderkey"], "left").select(F.col("o_orderkey").alias("block_number"), "o_custkey", absent_if_empty(F.col("lines")).alias("lines"))


@query("range_assign", f"SELECT o_orderkey AS block_number, {_LO} AS range_lo, {_HI} AS range_hi, printf('%010d-%010d.parquet', {_LO}, {_HI}) AS file_name FROM orders")
def range_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = order_blocks(spark, sf_dir)
    hi = range_hi(F.col("range_lo"), SIZE, end_of(blocks))
    return ranged(blocks).select("block_number", "range_lo", hi.alias("range_hi"), file_name(F.col("range_lo"), hi).alias("file_name"))


@query("range_counts", f"SELECT lo AS range_lo, least(lo + {SIZE}, {_END}) AS range_hi, printf('%010d-%010d.parquet', lo, least(lo + {SIZE}, {_END})) AS file_name, count(*) AS n_rows FROM (SELECT {_LO} AS lo FROM orders) GROUP BY lo")
def range_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = order_blocks(spark, sf_dir)
    per_range = ranged(blocks).groupBy("range_lo").agg(F.count("*").alias("n_rows"))
    hi = range_hi(F.col("range_lo"), SIZE, end_of(blocks))
    return per_range.select("range_lo", hi.alias("range_hi"), file_name(F.col("range_lo"), hi).alias("file_name"), "n_rows")


@query("range_bounds_filter", f"SELECT o_orderkey AS block_number, o_custkey, o_orderstatus FROM orders WHERE o_orderkey >= {START} AND o_orderkey < {STOP}")
def range_bounds_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_blocks(spark, sf_dir, START, STOP).select("block_number", "o_custkey", "o_orderstatus")


@query("range_minmax", f"SELECT {_LO} AS range_lo, min(o_orderkey) AS first_block, max(o_orderkey) AS last_block FROM orders GROUP BY 1")
def range_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranged(order_blocks(spark, sf_dir)).groupBy("range_lo").agg(F.min("block_number").alias("first_block"), F.max("block_number").alias("last_block"))


_GAP_LO = f"({GAP_START} + (greatest(doc_id, {GAP_START}) - {GAP_START}) // {GAP_SIZE} * {GAP_SIZE})"
_GAP_END = f"greatest({START + 1}, (SELECT max(doc_id) + 1 FROM labels))"
_EXPECTED = f"(SELECT unnest(range({GAP_START}, {_GAP_END}, {GAP_SIZE})) AS range_lo)"


def label_ranges(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The ranges up to the last label, and the rows that each range has; some have none."""
    blocks = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("block_number"))
    end = end_of(blocks)
    rows = blocks.groupBy(range_lo(F.col("block_number"), GAP_SIZE, GAP_START).alias("range_lo")).agg(F.count("*").alias("n_rows"))
    return expected_ranges(spark, GAP_START, end, GAP_SIZE, end), rows


@query("gap_backfill", f"SELECT e.range_lo, least(e.range_lo + {GAP_SIZE}, {_GAP_END}) AS range_hi, coalesce(n, 0)::BIGINT AS n_rows FROM {_EXPECTED} e LEFT JOIN (SELECT {_GAP_LO} AS lo, count(*) AS n FROM labels GROUP BY 1) ON lo = e.range_lo")
def gap_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected, rows = label_ranges(spark, sf_dir)
    return expected.join(rows, "range_lo", "left").select("range_lo", "range_hi", F.coalesce("n_rows", F.lit(0).cast("long")).alias("n_rows"))


@query("missing_ranges", f"SELECT e.range_lo, least(e.range_lo + {GAP_SIZE}, {_GAP_END}) AS range_hi FROM {_EXPECTED} e WHERE NOT EXISTS (SELECT 1 FROM labels WHERE {_GAP_LO} = e.range_lo)")
def missing_ranges_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_ranges(*label_ranges(spark, sf_dir))


@query("backfill_leading", f"SELECT e.range_lo FROM (SELECT unnest(range({START}, {_END}, {SIZE})) AS range_lo) e WHERE e.range_lo < (SELECT min({_LO}) FROM orders WHERE o_orderkey >= 3000)")
def backfill_leading(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = order_blocks(spark, sf_dir, 3000)
    first = ranged(blocks).agg(F.min("range_lo").alias("first"))
    end = end_of(blocks)
    return expected_ranges(spark, START, end, SIZE, end).crossJoin(F.broadcast(first)).filter("range_lo < first").select("range_lo")  # first is one row


@query("nest_explode", f"SELECT {_LINE} FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def nest_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_table(nested_orders(spark, sf_dir, False), "lines")


@query("explode_lineage", f"SELECT l_orderkey AS block_number, (row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE}) - 1)::INTEGER AS ordinal, {_LINE} FROM lineitem")
def explode_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_table(nested_orders(spark, sf_dir), "lines", "block_number")


@query("explode_scalar_list", "SELECT vec_id AS block_number, (i - 1)::INTEGER AS ordinal, embedding[i] AS embedding FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)")
def explode_scalar_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_table(table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "block_number"), "embedding", "block_number")


@query("explode_scalar_compat", "SELECT vec_id AS block_number, NULL::FLOAT AS embedding FROM (SELECT vec_id, unnest(embedding) AS x FROM embeddings)")
def explode_scalar_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_table(table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "block_number"), "embedding", None, True, ("block_number",))


@query("explode_map", "SELECT event_id AS block_number, 'k' AS key, CAST(json_extract(props, '$.k') AS BIGINT) AS value FROM events WHERE json_extract(props, '$.k') IS NOT NULL")
def explode_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = table(spark, sf_dir, "events").select(F.col("event_id").alias("block_number"), entries(F.from_json("props", "map<string,bigint>")).alias("props"))
    return explode_table(listed, "props", keep=("block_number",))


@query("main_table_list_sizes", "SELECT o_orderkey AS block_number, o_custkey, nullif(count(l_orderkey), 0)::INTEGER AS n_lines FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2")
def main_table_list_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sizes of the lists that nesting would make: nothing but the counts is shuffled."""
    orders = table(spark, sf_dir, "orders")
    sizes = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").cast("int").alias("n_lines"))
    return orders.join(sizes, orders["o_orderkey"] == sizes["l_orderkey"], "left").select(F.col("o_orderkey").alias("block_number"), "o_custkey", "n_lines")


@query("default_to_null", "SELECT doc_id, nullif(quality, 0) AS quality, nullif(toxic, 0) AS toxic FROM labels")
def default_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", absent_if(F.col("quality"), 0).alias("quality"), absent_if(F.col("toxic"), 0).alias("toxic"))


@query("empty_list_to_null", "SELECT doc_id, CASE WHEN len(words) > 0 THEN len(words)::INTEGER END AS n_long FROM (SELECT doc_id, list_filter(string_split(text, ' '), lambda x: length(x) > 14) AS words FROM documents)")
def empty_list_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    long_words = F.filter(F.split("text", " "), lambda x: F.length(x) > 14)
    listed = table(spark, sf_dir, "documents").select("doc_id", absent_if_empty(long_words).alias("words"))
    return listed.select("doc_id", F.when(F.col("words").isNotNull(), F.size("words")).alias("n_long"))


@query("enum_number", "SELECT o_orderkey AS block_number, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 WHEN 'P' THEN 3 END AS status FROM orders")
def enum_number_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("block_number"), enum_number(F.col("o_orderstatus"), STATUS).alias("status"))


@query("chat_roles", "SELECT conv_id AS block_number, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INTEGER AS ordinal, turn, CASE role WHEN 'system' THEN 1 WHEN 'user' THEN 2 WHEN 'assistant' THEN 3 END AS role, nullif(length(text), 0)::INTEGER AS n_chars FROM conversations")
def chat_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.struct("turn", enum_number(F.col("role"), ROLES).alias("role"), F.nullif(F.length("text"), F.lit(0)).alias("n_chars"))
    nested = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("block_number")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return explode_table(nested, "turns", "block_number")


@query("raw_envelope", "SELECT doc_id::DECIMAL(20,0)::VARCHAR AS block_number, source AS block_id, octet_length(encode(text))::INTEGER AS n_bytes, sha256(text) AS digest FROM documents WHERE text IS NOT NULL")
def raw_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("block_number"), F.col("source").alias("block_id"), F.col("text").cast("binary").alias("payload"))
    return raw_table(blocks).select(F.col("block_number").cast("string").alias("block_number"), "block_id", F.octet_length("payload").alias("n_bytes"), F.sha2("payload", 256).alias("digest"))


@query("payload_filter", "SELECT event_id AS block_number, event_type FROM events WHERE CASE WHEN event_id % 7 <> 0 THEN props END IS NOT NULL")
def payload_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = table(spark, sf_dir, "events").select(F.col("event_id").alias("block_number"), "event_type", F.when(F.col("event_id") % 7 != 0, F.col("props")).alias("payload"))
    return with_payload(blocks).select("block_number", "event_type")


@query("unsigned_cast", "SELECT o_orderkey AS block_number, (o_orderkey::DECIMAL(20,0) + 9223372036854775807)::DECIMAL(20,0)::VARCHAR AS u64, (o_orderkey + 2147483647)::BIGINT AS u32 FROM orders")
def unsigned_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(key.alias("block_number"), (key.cast("decimal(20,0)") + F.lit(9223372036854775807).cast("decimal(20,0)")).cast("decimal(20,0)").cast("string").alias("u64"), (key + F.lit(2147483647)).cast("long").alias("u32"))


@query("stats_rollup", f"SELECT o_orderstatus AS table_name, count(DISTINCT {_LO})::BIGINT AS files, count(*)::BIGINT AS n_rows, sum(CAST(o_totalprice * 100 AS DECIMAL(20,0)))::BIGINT AS cents, max({_LO}) AS active_range_lo, max_by(o_orderkey, o_orderkey) AS last_block FROM orders GROUP BY 1")
def stats_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.sum((F.col("o_totalprice") * 100).cast("decimal(20,0)")).cast("decimal(30,0)")
    # counted per range first, so that the shuffle carries a row for each range and task
    per_range = ranged(order_blocks(spark, sf_dir)).groupBy(F.col("o_orderstatus").alias("table_name"), "range_lo").agg(F.count("*").alias("n"), cents.alias("c"), F.max("block_number").alias("last"))
    return per_range.groupBy("table_name").agg(F.count("*").alias("files"), F.sum("n").alias("n_rows"), F.sum("c").cast("long").alias("cents"), F.max("range_lo").alias("active_range_lo"), F.max("last").alias("last_block"))


_DAYS = "SELECT event_type AS table_name, epoch(date_trunc('day', ts))::BIGINT AS sampled_at, count(*)::BIGINT AS n FROM events GROUP BY 1, 2"


@query("stats_rates", f"SELECT table_name, sampled_at, n_rows, coalesce((n_rows - lag(n_rows) OVER w)::DOUBLE / nullif(sampled_at - lag(sampled_at) OVER w, 0), 0)::DOUBLE AS n_rows_per_sec FROM (SELECT table_name, sampled_at, (sum(n) OVER (PARTITION BY table_name ORDER BY sampled_at))::BIGINT AS n_rows FROM ({_DAYS})) WINDOW w AS (PARTITION BY table_name ORDER BY sampled_at)")
def stats_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("table_name"), F.unix_timestamp(F.date_trunc("day", "ts")).alias("sampled_at")).agg(F.count("*").alias("n"))
    samples = daily.select("table_name", "sampled_at", F.sum("n").over(Window.partitionBy("table_name").orderBy("sampled_at")).alias("n_rows"))
    return rates(samples, "table_name", "sampled_at", ("n_rows",))


_UNDO_ROWS = ", ".join(f"({s}, {b})" for s, b in UNDOS)


@query("undo_apply", f"SELECT event_id AS block_number, event_type, user_id FROM events WHERE NOT EXISTS (SELECT 1 FROM (VALUES {_UNDO_ROWS}) u(seq, last_valid_block) WHERE u.seq > events.event_id AND u.last_valid_block < events.event_id)")
def undo_apply_(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = table(spark, sf_dir, "events").select(F.col("event_id").alias("block_number"), F.col("event_id").alias("seq"), "event_type", "user_id")
    return undo_apply(blocks, spark.createDataFrame(UNDOS, "seq long, last_valid_block long"), SIZE).select("block_number", "event_type", "user_id")


@query("ordered_within_range", f"SELECT {_LO} AS range_lo, o_orderkey AS block_number, row_number() OVER (PARTITION BY {_LO} ORDER BY o_orderkey)::INTEGER AS place FROM orders")
def ordered_within_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranged(order_blocks(spark, sf_dir)).select("range_lo", "block_number", F.row_number().over(Window.partitionBy("range_lo").orderBy("block_number")).alias("place"))


@query("flush_batches", f"SELECT {_LO} AS range_lo, ((row_number() OVER (PARTITION BY {_LO} ORDER BY o_orderkey) - 1) // {ROW_GROUP})::INTEGER AS row_group, o_orderkey AS block_number FROM orders")
def flush_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("range_lo").orderBy("block_number")) - 1
    return ranged(order_blocks(spark, sf_dir)).select("range_lo", F.floor(place / ROW_GROUP).cast("int").alias("row_group"), "block_number")


@query("cursor_resume", f"SELECT o_orderkey AS block_number, o_custkey FROM orders WHERE o_orderkey > {CURSOR}")
def cursor_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return after_cursor(order_blocks(spark, sf_dir), CURSOR).select("block_number", "o_custkey")


@query("reattach_parent", f"SELECT o_orderkey AS block_number, o_orderstatus, {_LINE} FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def reattach_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    exploded = explode_table(nested_orders(spark, sf_dir, False), "lines", "block_number").drop("ordinal")
    return exploded.join(order_blocks(spark, sf_dir).select("block_number", "o_orderstatus"), "block_number").select("block_number", "o_orderstatus", *LINE)


def written_orders(spark: SparkSession, sf_dir: str, runs: int) -> tuple[str, DataFrame]:
    """Orders through the sink, into the shared folder, by runs one behind the other; the folder, and the manifest."""
    from rangelake.functions.scratch import scratch_folder
    from rangelake.options import Options
    from rangelake.plans import sink
    from rangelake.sources.store import Store

    folder = scratch_folder(spark)
    blocks = order_blocks(spark, sf_dir).select("block_number", "o_custkey")
    end = end_of(blocks)
    size = min(max(SIZE, end // 20), 200_000)  # a range is one task, so its size is bounded
    options = Options(start_block=START, stop_block=end, partition_size=size, fill_gaps="none")
    for k in range(runs):
        sink.write_tables({"": within(blocks, end * k // runs, end * (k + 1) // runs)}, Store(spark, folder), options)
    return folder, sink.manifest(spark, Store(spark, folder))


_SIZED = f"({START} + (greatest(o_orderkey, {START}) - {START}) // size * size)"
_SIZES = f"(SELECT *, least(greatest({SIZE}, (max(o_orderkey) OVER () + 1) // 20), 200000) AS size FROM orders)"


@query("file_write_read", f"SELECT {_SIZED} AS range_lo, count(*) AS n_rows, min(o_orderkey) AS first_block, max(o_orderkey) AS last_block FROM {_SIZES} GROUP BY 1")
def file_write_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders through the sink: range files are written to the shared folder, and read back by their names."""
    folder, _ = written_orders(spark, sf_dir, 1)
    back = spark.read.schema("block_number long, o_custkey long").parquet(f"{folder}/*.parquet")
    lo = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)-", 1).cast("long")
    return back.groupBy(lo.alias("range_lo")).agg(F.count("*").alias("n_rows"), F.min("block_number").alias("first_block"), F.max("block_number").alias("last_block"))


@query("manifest_totals", f"SELECT '' AS table_name, count(DISTINCT {_SIZED})::BIGINT AS files, count(*)::BIGINT AS n_rows, max({_SIZED}) AS active_range_lo FROM {_SIZES} HAVING count(*) > 0")
def manifest_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders through the sink in three runs, of which the later ones go on with a range that the one before began."""
    _, rows = written_orders(spark, sf_dir, 3)
    return totals(rows).select(F.col("table").alias("table_name"), "files", F.col("rows").alias("n_rows"), "active_range_lo")


@query("decode_payloads", "SELECT o_orderkey AS block_number, nullif(o_custkey, 0) AS custkey, nullif(o_orderstatus, '') AS status, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 WHEN 'P' THEN 3 END AS state FROM orders")
def decode_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders encoded as protobuf messages, and decoded by their descriptor."""
    from rangelake.operators.decode import decode
    from rangelake.plans.order_message import MESSAGE, descriptor_set, encode_orders

    blocks = encode_orders(table(spark, sf_dir, "orders"), STATUS)
    return decode(blocks, descriptor_set(), MESSAGE)


@query("explode_payload_lists", f"SELECT l_orderkey AS block_number, (row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE}) - 1)::INTEGER AS ordinal, nullif(l_linenumber, 0)::BIGINT AS linenumber, nullif(l_partkey, 0)::DECIMAL(20,0)::VARCHAR AS partkey, nullif(l_quantity, 0)::DOUBLE AS quantity, nullif(l_returnflag, '') AS returnflag FROM lineitem JOIN orders ON o_orderkey = l_orderkey")
def explode_payload_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their lines as protobuf messages; the list of messages decoded and exploded."""
    from rangelake.operators.decode import decode
    from rangelake.plans.order_message import NESTED, descriptor_set, encode_nested

    blocks = encode_nested(nested_orders(spark, sf_dir))
    lines = explode_table(decode(blocks, descriptor_set(), NESTED, ["lines"]), "lines", "block_number")
    return lines.withColumn("partkey", F.col("partkey").cast("string"))


@query("quarantine_counts", "SELECT (o_orderstatus = 'P')::BOOLEAN AS quarantined, count(*)::BIGINT AS n FROM orders GROUP BY 1")
def quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as messages, those of one status cut short in the middle: permissive decoding sets them apart."""
    from rangelake.operators.decode import ERROR, decode
    from rangelake.plans.order_message import MESSAGE, descriptor_set, encode_orders

    orders = table(spark, sf_dir, "orders")
    blocks = encode_orders(orders, STATUS).join(orders.select(F.col("o_orderkey").alias("block_number"), "o_orderstatus"), "block_number")
    cut_short = blocks.withColumn("payload", F.when(F.col("o_orderstatus") == "P", F.concat(F.col("payload"), F.lit(b"\x12\x7f"))).otherwise(F.col("payload")))
    decoded = decode(cut_short, descriptor_set(), MESSAGE, [], "PERMISSIVE")
    return decoded.groupBy(F.col(ERROR).isNotNull().alias("quarantined")).agg(F.count("*").alias("n"))
