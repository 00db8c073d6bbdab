"""Best-fit packing by large-item matching.

How full sequences get depends on the lengths alone, so the plan is made on the histogram of lengths (as many numbers
as a sequence has tokens, however many documents there are): pieces above a third of the capacity, of which at most two
share a sequence, are matched greedily, the longest with the longest that still fits; shorter pieces then go, longest
first, where they leave the least room. The plan is a list of runs: of the pieces of one length, those ranked first to
last fill equal places of consecutive sequences. A piece's rank is its rank inside its part plus the pieces of that
length in the parts before, so no length, however common, meets in one task.

Defined cases: a null or empty text is one piece, the end id. A document longer than the capacity is cut into full
pieces and a rest. Repeated rows, and rows without doc_id, are packed each by itself. An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rangelake.llm.encoder import AT_ONCE, END, WORDS, encoder
from rangelake.llm.shared import cut, ids_crc32, steps

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 2048


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, first sequence, pieces a sequence, offset of the first piece), by length and rank."""
    left = {n: c for n, c in histogram.items() if c}
    placed: dict[int, int] = defaultdict(int)
    runs: list[tuple[int, int, int, int, int]] = []
    rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room left: (first sequence, how many)
    widths: list[int] = []  # rooms that there are, ascending
    opened = 0

    def place(length: int, count: int, sequence: int, each: int, offset: int) -> None:
        runs.append((length, placed[length], sequence, each, offset))
        placed[length] += count
        left[length] -= count

    def leave(room: int, sequence: int, count: int) -> None:
        if room and count:
            if not rooms[room]:
                insort(widths, room)
            rooms[room].append((sequence, count))

    large = sorted(n for n in left if 3 * n > capacity)
    for length in reversed(large):
        while left[length]:
            at = bisect_left(large, min(length, capacity - length) + 1) - 1
            while at >= 0 and not left[large[at]]:
                at -= 1
            partner = large[at] if at >= 0 else 0
            many = left[length] if not partner else left[length] // 2 if partner == length else min(left[length], left[partner])
            if partner == length and not many:  # the last of its length looks for a shorter one
                at -= 1
                while at >= 0 and not left[large[at]]:
                    at -= 1
                partner, many = (large[at], 1) if at >= 0 else (0, 1)
            if partner == length:
                place(length, 2 * many, opened, 2, 0)
            else:
                place(length, many, opened, 1, 0)
                if partner:
                    place(partner, many, opened, 1, length)
            leave(capacity - length - partner, opened, many)
            opened += many
    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            at = bisect_left(widths, length)
            if at == len(widths):
                each = capacity // length
                room, sequence, count = capacity, opened, -(-left[length] // each)
                opened += count
            else:
                room = widths[at]
                sequence, count = rooms[room].pop()
                if not rooms[room]:
                    widths.pop(at)
            each = min(room // length, left[length])
            full = min(count, left[length] // each)
            place(length, full * each, sequence, each, capacity - room)
            leave(room - each * length, sequence, full)
            leave(room, sequence + full, count - full)
    return sorted(runs)


def _pieces(batches: Iterator[pa.RecordBatch], vocabulary: str, capacity: int, words: int) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    met: dict[int, int] = defaultdict(int)
    for batch in steps(batches, most=AT_ONCE):
        rows: list[tuple] = []
        texts = [t or "" for t in batch.column("text").to_pylist()]
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder(vocabulary, words).encode(texts), strict=True):
            ids += END
            for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                own = ids[at : at + 4 * capacity]
                rows.append((doc_id, piece, at // 4, len(own) // 4, ids_crc32(own), part, met[len(own) // 4]))
                met[len(own) // 4] += 1
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 7, kinds, strict=True)], names)


def _assign(batches: Iterator[pa.RecordBatch], runs: np.ndarray) -> Iterator[pa.RecordBatch]:
    keys = (runs[:, 0] << 44) + runs[:, 1]  # sorted, as runs are
    for batch in batches:
        length, rank = (np.asarray(batch.column(c)) for c in ("length", "rank"))
        own = runs[np.searchsorted(keys, (length << 44) + rank, side="right") - 1] if batch.num_rows else np.zeros((0, 5), np.int64)
        since = rank - own[:, 1]
        sequence = own[:, 2] + since // np.maximum(own[:, 3], 1)
        offset = own[:, 4] + since % np.maximum(own[:, 3], 1) * length
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])


def best_fit_pack(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY, words: int = WORDS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. ``words``: that a worker's cache holds."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"
    pieces = cut(docs.select("doc_id", "text").mapInArrow(lambda b: _pieces(b, vocabulary, capacity, words), schema), "pieces")
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    runs = np.array(plan(histogram, capacity), dtype=np.int64).reshape(-1, 5)
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = pieces.join(counts.select("length", "part", before.cast("long").alias("before")), ["length", "part"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))
    return ranked.mapInArrow(lambda b: _assign(b, runs), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
