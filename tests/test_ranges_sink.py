from __future__ import annotations

import glob
import os
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rangelake import cli
from rangelake.functions.ranges import file_name, range_hi, range_lo
from rangelake.operators.explode import explode_table
from rangelake.operators.stats import totals
from rangelake.options import Options, codec, from_environment, stop_block
from rangelake.plans import sink
from rangelake.sources.envelope import ENVELOPE
from rangelake.sources.store import Store, normalise_url, probe
from tests.fixtures import data, descriptor_set, kind, roots

SET = descriptor_set()


def files(path, table=""):
    return {os.path.basename(f): pq.ParquetFile(f) for f in sorted(glob.glob(f"{path}/{table}/*.parquet" if table else f"{path}/*.parquet"))}


@pytest.mark.parametrize(
    ("start", "end", "size", "block", "name"),
    [
        (19000000, None, 5000, 19000000, "0019000000-0019005000.parquet"),
        (19000000, None, 5000, 19004999, "0019000000-0019005000.parquet"),
        (19000000, None, 5000, 19005000, "0019005000-0019010000.parquet"),
        (100, None, 300, 99, "0000000100-0000000400.parquet"),
        (100, None, 300, 399, "0000000100-0000000400.parquet"),
        (100, 900, 300, 899, "0000000700-0000000900.parquet"),
    ],
)
def test_range_names(spark, start, end, size, block, name):
    lo = range_lo(F.lit(block), size, start)
    assert spark.range(1).select(file_name(lo, range_hi(lo, size, end)).alias("f")).first()["f"] == name


def test_bounds():
    with pytest.raises(ValueError):
        Options(partition_size=0)
    with pytest.raises(ValueError):
        Options(start_block=5, stop_block=5)
    assert stop_block("+15000", 10) == 15010 and stop_block("7", 0) == 7 and stop_block("", 3) is None


def test_blocks_from_stop_on_are_left_out(spark):
    df = spark.createDataFrame([(899,), (900,), (1000,)], "block_number long")
    assert [r["range_lo"] for r in sink.with_range(df, Options(start_block=100, stop_block=900, partition_size=300)).collect()] == [700]


def test_options_from_environment():
    o = from_environment({"RANGELAKE_EXPLODE": "true", "RANGELAKE_START_BLOCK": "10", "RANGELAKE_STOP_BLOCK": "+5"}, partition_size=7)
    assert o.explode and o.start_block == 10 and o.stop_block == 15 and o.partition_size == 7
    assert codec("LZ4") == "lz4_raw" and codec("") == "none"
    with pytest.warns(UserWarning):
        assert codec("brotli") == "zstd"


def test_explode_rules(spark):
    df = spark.createDataFrame([(10, ["x", "", "y"], [(1, "a"), (None, None)]), (11, [], None)], "block_number long, tags array<string>, items array<struct<v:int,k:string>>")
    assert [r["tags"] for r in explode_table(df, "tags").collect()] == ["x", "", "y"]
    assert [r["tags"] for r in explode_table(df, "tags", scalar_compat=True).collect()] == [None] * 3
    lineage = explode_table(df, "items", "block_number")
    assert lineage.columns == ["block_number", "ordinal", "v", "k"] and [tuple(r) for r in lineage.collect()] == [(10, 0, 1, "a"), (10, 1, None, None)]


def table_rows(spark, path):
    return {n: f.metadata.num_rows for n, f in files(path).items()}


def test_runs_over_consecutive_blocks_keep_all_rows(spark, tmp_path):
    """The manifest only grows, and no empty file takes the place of one that is there."""
    for option in ("leading", "all"):
        out = tmp_path / option
        for lo in (0, 10, 20, 30):
            blocks = spark.createDataFrame([data(b, b, kind("Root")(n=b)) for b in range(lo, lo + 5)], ENVELOPE)
            sink.write_blocks(blocks, f"file://{out}", SET, Options(partition_size=10, message="t.Root", fill_gaps=option))
        assert table_rows(spark, out) == {f"{lo:010d}-{lo + 10:010d}.parquet": 5 for lo in (0, 10, 20, 30)}


def test_a_range_is_gone_on_with_or_refused(spark, tmp_path):
    write = lambda blocks, **more: sink.write_blocks(spark.createDataFrame([data(b, b, kind("Root")(n=b + 1)) for b in blocks], ENVELOPE), f"file://{tmp_path}", SET, Options(partition_size=10, message="t.Root", **more))
    write([0, 1, 2])
    write([3, 4, 12])
    read = lambda name: files(tmp_path)[name].read()["n"].to_pylist()
    assert read("0000000000-0000000010.parquet") == [1, 2, 3, 4, 5] and read("0000000010-0000000020.parquet") == [13]
    write([0, 1, 2, 3, 4])  # the same blocks: written anew
    assert read("0000000000-0000000010.parquet") == [1, 2, 3, 4, 5]
    with pytest.raises(ValueError, match="can't be added"):
        write([4, 5, 13])
    assert read("0000000000-0000000010.parquet") == [1, 2, 3, 4, 5] and read("0000000010-0000000020.parquet") == [13]
    write([13, 14], max_records_per_file=1)
    assert read("0000000010-0000000020.parquet") == [13] and read("0000000010-0000000020.1.parquet") == [14] and read("0000000010-0000000020.2.parquet") == [15]
    write([15])
    assert read("0000000010-0000000020.parquet") == [13, 14, 15, 16] and not os.path.exists(tmp_path / "0000000010-0000000020.1.parquet")
    t = totals(sink.manifest(spark, Store(spark, f"file://{tmp_path}"))).first()
    assert (t["files"], t["rows"], t["last_rows"]) == (2, 9, 4)


def test_many_empty_files_are_fast(spark, tmp_path):
    began = time.time()
    rows = sink.write_blocks(spark.createDataFrame([data(1, 10_005, kind("Root")(n=1))], ENVELOPE), f"file://{tmp_path}", SET, Options(partition_size=10, message="t.Root"))
    assert len(rows) == 1001 and time.time() - began < 30 and sum(table_rows(spark, tmp_path).values()) == 1


def test_level_page_size_and_records(spark, tmp_path):
    blocks = spark.createDataFrame([data(i, i, kind("Root")(n=i * 7919 % 10007, tags=[f"t{i * 31 % 997}"] * 3)) for i in range(1, 2001)], ENVELOPE)
    size = {}
    for level in (1, 19):
        sink.write_blocks(blocks, f"file://{tmp_path}/{level}", SET, Options(message="t.Root", compression_level=level, dict_encoding=False))
        size[level] = os.path.getsize(glob.glob(f"{tmp_path}/{level}/*.parquet")[0])
    assert size[19] != size[1]
    pages = {}
    for page in (1 << 10, 1 << 20):
        sink.write_blocks(blocks, f"file://{tmp_path}/p{page}", SET, Options(message="t.Root", page_size=page, dict_encoding=False, compression="none"))
        pages[page] = os.path.getsize(glob.glob(f"{tmp_path}/p{page}/*.parquet")[0])
    assert pages[1 << 10] > pages[1 << 20]  # more pages, more headers
    sink.write_blocks(blocks, f"file://{tmp_path}/m", SET, Options(message="t.Root", max_records_per_file=900))
    assert sorted(f.metadata.num_rows for f in files(tmp_path / "m").values()) == [200, 900, 900]


def test_target_file_bytes(spark, tmp_path):
    blocks = spark.createDataFrame([data(i, i, kind("Root")(n=i * 7919 % 10007, tags=[f"t{i * 31 % 997}"] * 3)) for i in range(1, 2001)], ENVELOPE)
    size = {}
    for target in (0, 10_000, 1 << 30):
        sink.write_blocks(blocks, f"file://{tmp_path}/{target}", SET, Options(message="t.Root", target_file_bytes=target, dict_encoding=False))
        found = files(tmp_path / str(target))
        size[target] = len(found)
        assert sum(f.metadata.num_rows for f in found.values()) == 2000
    assert size[0] == size[1 << 30] == 1 < size[10_000]
    back = spark.read.parquet(*sorted(glob.glob(f"{tmp_path}/10000/*.parquet"))).select("n")
    assert {r["n"] for r in back.collect()} == {i * 7919 % 10007 for i in range(1, 2001)}


def test_gap_files(spark, tmp_path):
    blocks = spark.createDataFrame([data(i, b, kind("Root")(n=b)) for i, b in enumerate((250, 255, 460))], ENVELOPE)
    sink.write_blocks(blocks, f"file://{tmp_path}/a", SET, Options(partition_size=100, message="t.Root"))
    assert {k: f.metadata.num_rows for k, f in files(tmp_path / "a").items()} == {"0000000000-0000000100.parquet": 0, "0000000100-0000000200.parquet": 0, "0000000200-0000000300.parquet": 2, "0000000400-0000000500.parquet": 1}
    sink.write_blocks(blocks, f"file://{tmp_path}/b", SET, Options(partition_size=100, message="t.Root", fill_gaps="all"))
    assert "0000000300-0000000400.parquet" in files(tmp_path / "b")
    # again: finished ranges are not emptied
    sink.write_blocks(blocks, f"file://{tmp_path}/a", SET, Options(partition_size=100, message="t.Root"))
    assert files(tmp_path / "a")["0000000200-0000000300.parquet"].metadata.num_rows == 2


def test_explode_files(spark, tmp_path):
    blocks = spark.createDataFrame(roots(), ENVELOPE)
    rows = sink.write_blocks(blocks, f"file://{tmp_path}", SET, Options(partition_size=2, start_block=10, message="t.Root", explode=True))
    assert {(r[0], r[1], r[4]) for r in rows} == {("items", 10, 2), ("items", 12, 1), ("tags", 10, 3)}
    items = files(tmp_path, "items")["0000000010-0000000012.parquet"].read().to_pylist()
    assert items == [{"k": "a", "v": 1, "xs": [1, 2]}, {"k": None, "v": None, "xs": None}]
    assert files(tmp_path, "tags")["0000000010-0000000012.parquet"].read()["tags"].to_pylist() == ["x", "", "y"]
    assert not glob.glob(f"{tmp_path}/*.parquet") and not os.path.exists(tmp_path / "attrs")
    t = {r["table"]: r for r in totals(sink.manifest(spark, Store(spark, f"file://{tmp_path}"))).collect()}
    assert t["items"]["files"] == 2 and t["items"]["rows"] == 3 and t["items"]["active_range_lo"] == 12


def test_main_table(spark, tmp_path):
    sink.write_blocks(spark.createDataFrame(roots(), ENVELOPE), f"file://{tmp_path}", SET, Options(partition_size=100, message="t.Root"))
    table = files(tmp_path)["0000000000-0000000100.parquet"].read()
    assert table.column_names == ["n", "items", "tags", "attrs", "one"] and table["n"].to_pylist() == [1, 2, None] and table["items"].to_pylist()[1] is None


def test_no_lists(spark, tmp_path):
    with pytest.raises(ValueError, match="no root list"):
        sink.write_blocks(spark.createDataFrame([data(1, 1, kind("NoLists")(n=1))], ENVELOPE), f"file://{tmp_path}", SET, Options(message="t.NoLists", explode=True))


def test_quarantine(spark, tmp_path):
    blocks = spark.createDataFrame([data(1, 20, kind("Root")(n=1)), data(2, 21, b"\x12\x99")], ENVELOPE)
    sink.write_blocks(blocks, f"file://{tmp_path}", SET, Options(message="t.Root", mode="PERMISSIVE"))
    assert spark.read.parquet(f"{tmp_path}/_quarantine/batch").first()["block_number"] == 21
    assert files(tmp_path)["0000000000-0000005000.parquet"].metadata.num_rows == 1


@pytest.mark.parametrize(("name", "expected"), [("zstd", "ZSTD"), ("snappy", "SNAPPY"), ("gzip", "GZIP"), ("lz4", "LZ4"), ("none", "UNCOMPRESSED")])
def test_codecs(spark, tmp_path, name, expected):
    blocks = spark.createDataFrame([data(1, 1, kind("Root")(n=1))], ENVELOPE)
    sink.write_blocks(blocks, f"file://{tmp_path}", SET, Options(message="t.Root", compression=name))
    assert files(tmp_path).popitem()[1].metadata.row_group(0).column(0).compression == expected


def test_writer_options(spark, tmp_path):
    blocks = spark.createDataFrame([data(i, i, kind("Root")(n=i)) for i in range(1, 251)], ENVELOPE)
    sink.write_blocks(blocks, f"file://{tmp_path}", SET, Options(message="t.Root", row_group_rows=100, dict_encoding=False, parquet_stats=False))
    meta = files(tmp_path).popitem()[1].metadata
    column = meta.row_group(0).column(0)
    assert meta.num_row_groups == 3 and not any("DICT" in e for e in column.encodings) and (column.statistics is None or not column.statistics.has_min_max)


def test_store(spark, tmp_path):
    assert normalise_url("x/y").startswith("file:///") and normalise_url("s3://b/p?region=r", "pre") == "s3://b/p/pre?region=r"
    probe(spark, str(tmp_path))
    assert not glob.glob(f"{tmp_path}/.rangelake-setup/probe*")


def test_command_line(spark, tmp_path):
    spark.createDataFrame(roots(), ENVELOPE).write.parquet(f"{tmp_path}/in")
    (tmp_path / "set").write_bytes(SET)
    assert cli.main(["setup", str(tmp_path / "out")], spark) == 0
    assert cli.main(["run", str(tmp_path / "out"), str(tmp_path / "in"), "--descriptors", str(tmp_path / "set"), "--message", "t.Root", "--explode", "true", "--partition-size", "100"], spark) == 0
    assert files(tmp_path / "out", "items")["0000000000-0000000100.parquet"].metadata.num_rows == 3
