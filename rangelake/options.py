"""Settings of a run, their defaults, their checks, and their environment variables (``RANGELAKE_<NAME>``)."""

from __future__ import annotations

import os
import warnings
from collections.abc import Mapping
from dataclasses import dataclass, fields

from rangelake.functions.ranges import check_bounds

# Codecs by name; any other name means zstd, an empty name no compression.
CODECS = {"snappy": "snappy", "gzip": "gzip", "lz4": "lz4_raw", "uncompressed": "none", "none": "none", "": "none", "zstd": "zstd"}


def codec(name: str) -> str:
    """Spark's name of a codec."""
    known = CODECS.get(name.lower())
    if known is None:
        warnings.warn(f"compression {name!r} isn't known; zstd is used", stacklevel=2)
    return known or "zstd"


@dataclass(frozen=True)
class Options:
    start_block: int = 0
    stop_block: int | None = None
    partition_size: int = 5000
    pad_width: int = 10
    output_prefix: str = ""
    tmp_dir: str = ""
    message: str = ""
    compression: str = "zstd"
    compression_level: int = 0
    row_group_rows: int = 20_000
    page_size: int = 0
    dict_encoding: bool = True
    parquet_stats: bool = True
    target_file_bytes: int = 0
    max_records_per_file: int = 0
    flush_interval: str = "1s"
    explode: bool = False
    explode_scalar_compat: bool = False
    with_block_columns: bool = False
    with_lineage: bool = False
    wkt_timestamps: bool = False
    mode: str = "FAILFAST"
    fill_gaps: str = "leading"
    undo_buffer_size: int = 0
    max_files_per_trigger: int = 0
    max_depth: int = 16

    def __post_init__(self) -> None:
        check_bounds(self.partition_size, self.start_block, self.stop_block)
        if self.mode not in ("FAILFAST", "PERMISSIVE"):
            raise ValueError(f"mode must be FAILFAST or PERMISSIVE, not {self.mode!r}")
        if self.fill_gaps not in ("none", "leading", "all"):
            raise ValueError(f"fill_gaps must be none, leading or all, not {self.fill_gaps!r}")
        if self.undo_buffer_size < 0:
            raise ValueError("undo_buffer_size can't be negative")

    def writer(self) -> dict[str, str]:
        """Options of Spark's Parquet writer."""
        chosen = codec(self.compression)
        out = {
            "compression": chosen,
            "parquet.block.row.count.limit": str(self.row_group_rows),
            "parquet.enable.dictionary": str(self.dict_encoding).lower(),
            "parquet.column.statistics.enabled": str(self.parquet_stats).lower(),
        }
        if self.compression_level and chosen in ("zstd", "gzip"):
            out["parquet.compression.codec.zstd.level" if chosen == "zstd" else "zlib.compress.level"] = str(self.compression_level)
        if self.page_size:
            out["parquet.page.size"] = str(self.page_size)
        if self.max_records_per_file:
            out["maxRecordsPerFile"] = str(self.max_records_per_file)
        return out


def stop_block(value: str | int | None, start: int) -> int | None:
    """An absolute stop block, or one relative to the start (``+15000``); nothing and 0 mean open."""
    if value in (None, "", 0, "0"):
        return None
    text = str(value)
    return start + int(text[1:]) if text.startswith("+") else int(text)


def from_environment(environ: Mapping[str, str] = os.environ, **given) -> Options:
    """Options of RANGELAKE_<NAME> variables; what is given by name wins."""
    values = {}
    for f in fields(Options):
        raw = given.get(f.name, environ.get(f"RANGELAKE_{f.name.upper()}"))
        if raw is None:
            continue
        if isinstance(raw, str) and f.name != "stop_block":
            kind = type(f.default)
            raw = raw.lower() in ("1", "true", "yes") if kind is bool else kind(raw)
        values[f.name] = raw
    if "stop_block" in values:
        values["stop_block"] = stop_block(values["stop_block"], values.get("start_block", 0))
    return Options(**values)
