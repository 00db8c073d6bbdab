"""N-gram Jaccard join with Bayesian candidate pruning.

Texts are sets of five-word shingles (words are runs of letters, digits and underscores in lower case; a shorter text is
one shingle). Texts with the same words form one class, whose row with the smallest doc_id stands for it. Each class has
a MinHash signature; classes that agree on a band of it meet in a bucket. A bucket is cut into blocks by hash and every
two blocks are a tile of at most about 2 BLOCK classes, so no bucket, however large, lands in one task. In a tile,
signatures are compared a few values at a time, and a pair is dropped when the posterior probability that its similarity
reaches the threshold falls below TOLERANCE; a pair is looked at only in the first band that it shares. What is left is
verified exactly on the shingle sets, which are fetched only for classes with such a pair.

A tile returns, for each class, how many documents it links to, and links that connect what the tile connects (at most
one for each class): pairs never become rows. Connected classes get one class id by large-star and small-star rounds.

Result: one row per row of the input: doc_id, class_id (the smallest doc_id of all documents that links connect with
it, itself if none), n_links (how many other documents have a similarity of at least the threshold, copies included).

Defined cases: texts without a word (null, empty, marks only) are linked to nothing. Rows without doc_id have no class
and no link. Every row counts by itself: rows that repeat doc_id and text are copies of one another, and a doc_id that
stands at several texts has a row, and maybe a class, for each of them. An empty table gives an empty result. Other
columns are ignored, and carried along by ``drop_near_duplicates``.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangelake.llm.shared import cut, shared_folder, steps, without

SHINGLE, THRESHOLD, TOLERANCE = 5, 0.8, 1e-6
BANDS, ROWS = 16, 4
VALUES = BANDS * ROWS
#: MinHash values compared at once.
STEP = 16
#: Classes in a block of a bucket; a tile has two blocks.
BLOCK = 512
_WORD = re.compile(r"\w+")
_BASE = 0x9E3779B97F4A7C15 | 1


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE^i and its inverse, modulo 2^64, for i < n; kept and grown as needed."""
    have = _powers.__dict__.get("kept")
    if have is None or len(have[0]) < n:
        n = max(n, 1 << 16)
        grown = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.ones(1, dtype=np.uint64)
            while len(p) < n:
                p = np.concatenate([p, p * np.uint64(pow(base, len(p), 1 << 64))])
            grown.append(p)
        have = _powers.__dict__["kept"] = tuple(grown)
    return have


def shingles(text: str | None) -> np.ndarray:
    """64-bit hashes of the text's shingles, one for each place; empty without a word."""
    data = " ".join(_WORD.findall(text.lower())).encode("utf-8", "replace") if text else b""
    return _shingles_of(data)


def _shingles_of(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, dtype=np.uint64)
    raw = np.frombuffer(data, dtype=np.uint8)
    spaces = np.flatnonzero(raw == 32)
    begins, ends = np.append(0, spaces + 1), np.append(spaces, len(raw))
    n = max(1, len(begins) - SHINGLE + 1)
    a, z = begins[:n], ends[min(SHINGLE, len(ends)) - 1 :][:n]
    up, down = _powers(len(raw) + 1)
    with np.errstate(over="ignore"):
        # sum of byte * base^-i up to each place; a window's difference times base^end is free of where it stands
        total = np.append(np.uint64(0), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * down[: len(raw)], dtype=np.uint64))
        return _mix((total[z] - total[a]) * up[z])


_RANDOM = np.random.default_rng(20240229)
_A = _RANDOM.integers(0, 1 << 64, VALUES, dtype=np.uint64) | np.uint64(1)
_B = _RANDOM.integers(0, 1 << 64, VALUES, dtype=np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values of each set (32 bits each); a row of ones for an empty set."""
    out = np.full((len(sets), VALUES), 0xFFFFFFFF, dtype=np.uint32)
    full = [i for i, s in enumerate(sets) if len(s)]
    lo = 0
    while lo < len(full):  # about 2^16 shingles at a time, to stay in the processor's cache
        hi, held = lo, 0
        while hi < len(full) and (hi == lo or held + len(sets[full[hi]]) <= 1 << 16):
            held += len(sets[full[hi]])
            hi += 1
        own = full[lo:hi]
        x = np.concatenate([sets[i] for i in own])
        starts = np.cumsum([0] + [len(sets[i]) for i in own[:-1]])
        with np.errstate(over="ignore"):
            for k in range(VALUES):
                out[own, k] = np.minimum.reduceat(((x * _A[k] + _B[k]) >> np.uint64(32)).astype(np.uint32), starts)
        lo = hi
    return out


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """After n compared values, how many must match: fewer make P(similarity >= threshold) < tolerance, from a flat prior.

    The posterior is Beta(m + 1, n - m + 1), whose tail above t is the chance of at most m successes in n + 1 draws.
    """
    need = {}
    for n in range(STEP, VALUES + 1, STEP):
        tail, m = 0.0, -1
        while tail < tolerance:
            m += 1
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        need[n] = m
    return need


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches):
        data = [" ".join(_WORD.findall(t.lower())).encode("utf-8", "replace") if t else b"" for t in batch.column("text").to_pylist()]
        keys = [hashlib.blake2b(d, digest_size=16).digest() if d else None for d in data]
        rows = signatures([_shingles_of(d) for d in data])
        signed = [r.tobytes() if d else None for r, d in zip(rows, data, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), pa.array(keys, pa.binary()), pa.array(signed, pa.binary())], ["doc_id", "mark", "key", "signature"])


def _bands(signature: np.ndarray) -> np.ndarray:
    """A number for each band of each signature."""
    with np.errstate(over="ignore"):
        out = np.zeros((len(signature), BANDS), dtype=np.uint64)
        for k in range(ROWS):
            out = _mix(out * np.uint64(_BASE) + signature[:, k::ROWS].astype(np.uint64) + np.uint64(1))
    return out


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        signature = np.array([np.frombuffer(s, np.uint32) for s in batch.column("signature").to_pylist()], dtype=np.uint32).reshape(-1, VALUES)
        bands = _bands(signature).view(np.int64)
        n = batch.num_rows
        nodes = np.repeat(np.asarray(batch.column("node")), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(np.tile(np.arange(BANDS, dtype=np.int32), n)), pa.array(bands.reshape(-1))], ["node", "band", "bucket"])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of equal tile; the rows come sorted by it."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = list(zip(*(np.asarray(batch.column(c)).tolist() for c in ("band", "bucket", "i", "j")), strict=True))
        begin = 0
        for k in range(len(key) + 1):
            if k == len(key) or key[k] != (current if k == begin else key[begin]):
                if k > begin:
                    held.append(batch.slice(begin, k - begin))
                    current = key[begin]
                if k < len(key):
                    if held:
                        yield pa.Table.from_batches(held)
                    held, begin, current = [], k, key[k]
    if held:
        yield pa.Table.from_batches(held)


def _pairs(tile: pa.Table, need: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Places in the tile of the pairs that it is the first to see and that pruning leaves."""
    band = tile["band"][0].as_py()
    n = tile.num_rows
    signature = np.frombuffer(b"".join(tile["signature"].to_pylist()), dtype=np.uint32).reshape(n, VALUES)
    same = tile["i"][0].as_py() == tile["j"][0].as_py()
    if same:
        a, b = np.triu_indices(n, 1)
    else:
        block = np.asarray(tile["block"])
        left, right = np.flatnonzero(block == tile["i"][0].as_py()), np.flatnonzero(block == tile["j"][0].as_py())
        a, b = np.repeat(left, len(right)), np.tile(right, len(left))
    bands = _bands(signature) if band else None
    for k in range(band):
        fresh = bands[a, k] != bands[b, k]
        a, b = a[fresh], b[fresh]
    matches = np.zeros(len(a), dtype=np.int16)
    for n_seen in range(STEP, VALUES + 1, STEP):
        if not len(a):
            break
        for k in range(n_seen - STEP, n_seen):
            matches += signature[a, k] == signature[b, k]
        keep = matches >= need[n_seen]
        a, b, matches = a[keep], b[keep], matches[keep]
    return a, b


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    need = least_matches()
    for tile in _groups(batches):
        a, b = _pairs(tile, need)
        if len(a):
            kept = tile.take(pa.array(np.unique(np.concatenate([a, b])))).combine_chunks()
            yield from kept.to_batches()


def _verified(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Of each tile: class, linked documents, and a class that it is connected with (itself for none)."""
    need = least_matches(threshold)
    for tile in _groups(batches):
        a, b = _pairs(tile, need)
        nodes, weights = np.asarray(tile["node"]), np.asarray(tile["weight"])
        sets = [np.frombuffer(s, dtype=np.uint64) for s in tile["shingles"].to_pylist()]
        sizes = np.array([len(s) for s in sets])
        if len(a):
            # shingles of two classes or more as bits; those of one class are in no intersection
            every = np.concatenate(sets)
            values, counts = np.unique(every, return_counts=True)
            shared = values[counts > 1]
            bits = np.zeros((len(sets), -(-max(len(shared), 1) // 64) * 8), dtype=np.uint8)
            for row, s in zip(bits, sets, strict=True):
                at = np.searchsorted(shared, s)
                at = at[(at < len(shared)) & (shared[np.minimum(at, len(shared) - 1)] == s)] if len(shared) else at[:0]
                np.bitwise_or.at(row, at >> 3, (1 << (at & 7)).astype(np.uint8))
            packed = bits.view(np.uint64)
            common = np.zeros(len(a), dtype=np.int64)
            step = max(1, (1 << 21) // packed.shape[1])
            for lo in range(0, len(a), step):
                common[lo : lo + step] = np.bitwise_count(packed[a[lo : lo + step]] & packed[b[lo : lo + step]]).sum(axis=1)
            linked = common >= threshold * (sizes[a] + sizes[b] - common) - 1e-9
            a, b = a[linked], b[linked]
        if not len(a):
            continue
        links = np.bincount(a, weights=weights[b], minlength=len(nodes)) + np.bincount(b, weights=weights[a], minlength=len(nodes))
        root = np.arange(len(nodes))
        while True:  # smallest place that links reach inside the tile
            low = root.copy()
            np.minimum.at(low, a, root[b])
            np.minimum.at(low, b, root[a])
            low = low[low]
            if (low == root).all():
                break
            root = low
        own = np.flatnonzero(links > 0)
        yield pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(links[own].astype(np.int64)), pa.array(nodes[root[own]])], ["node", "links", "other"])


def connected(edges: DataFrame, folder: str) -> DataFrame:
    """(node, root) of all nodes of ``edges`` (a, b), root being the smallest node that they reach; large-star, small-star."""
    edges = cut(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges-0", folder)
    seen = None
    for turn in range(1, 200):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # a star's centre is hot: with the least cut off, Spark can split the join
        least = cut(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), f"least-{turn}", folder)
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        edges = cut(small, f"edges-{turn}", folder)
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if seen == state:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _tiles(buckets: DataFrame) -> DataFrame:
    """(node, band, bucket, block, i, j): each class of a bucket of two or more, once for each tile of its block."""
    sizes = buckets.groupBy("band", "bucket").agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = buckets.join(sizes, ["band", "bucket"]).select("node", "band", "bucket", blocks.alias("blocks"), F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block"))
    met = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return placed.select("node", "band", "bucket", "block", met).select("node", "band", "bucket", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))


def _linked(docs: DataFrame, threshold: float, folder: str) -> tuple[DataFrame, DataFrame]:
    """Rows as (doc_id, mark, key), and of each key: class_id, n_links, and doc_id and mark of its group's first row.

    A class is numbered, as its doc_id may stand at other texts, too; ``mark`` tells the texts of a doc_id apart.
    """
    keyed = docs.select("doc_id", "text", F.md5(F.coalesce("text", F.lit(""))).alias("mark")).mapInArrow(_classes, "doc_id long, mark string, key binary, signature binary")
    keyed = cut(keyed, "keyed", folder)
    worded = keyed.filter(F.col("key").isNotNull() & F.col("doc_id").isNotNull())
    classes = worded.groupBy("key").agg(F.min(F.struct("doc_id", "mark")).alias("first"), F.count("*").alias("weight"), F.min("signature").alias("signature"))
    classes = cut(classes.select(F.monotonically_increasing_id().alias("node"), "*"), "classes", folder)

    buckets = cut(classes.select("node", "signature").mapInArrow(_buckets, "node long, band int, bucket long"), "buckets", folder)
    tile_key = ["band", "bucket", "i", "j"]
    light = _tiles(buckets).join(classes.select("node", "weight", "signature"), "node")
    light = light.select("node", "weight", "signature", "block", *tile_key)
    # dealt by ranges, as hashes put several large tiles into one task
    candidates = cut(light.repartitionByRange(*tile_key).sortWithinPartitions(*tile_key).mapInArrow(_candidates, light.schema), "candidates", folder)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            own = [np.unique(shingles(t)).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(own, pa.binary())], ["node", "shingles"])

    wanted = classes.join(candidates.select("node").distinct(), "node", "left_semi").select("node", "first.*")
    # merged at every size: a broadcast that small inputs happen to get would not carry over to large ones
    marked = docs.select("doc_id", "text", F.md5(F.coalesce("text", F.lit(""))).alias("mark"))
    texts = marked.join(wanted.hint("merge"), ["doc_id", "mark"]).select("node", "text").mapInArrow(sets, "node long, shingles binary")
    texts = cut(texts.dropDuplicates(["node"]), "shingles", folder)
    heavy = candidates.join(texts, "node").repartitionByRange(*tile_key).sortWithinPartitions(*tile_key)
    verified = cut(heavy.mapInArrow(lambda b: _verified(b, threshold), "node long, links long, other long"), "verified", folder)

    roots = connected(verified.select(F.col("node").alias("a"), F.col("other").alias("b")), folder)
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    settled = classes.drop("signature").join(links, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    settled = cut(settled, "settled", folder)
    firsts = settled.groupBy("root").agg(F.min("first").alias("group"))
    settled = settled.join(firsts, "root")  # as many rows as classes; a large group's are split by Spark
    n_links = F.coalesce("links", F.lit(0)) + F.col("weight") - 1
    return keyed.select("doc_id", "mark", "key"), settled.select("key", F.col("group.doc_id").alias("class_id"), n_links.alias("n_links"), F.col("group.mark").alias("first_mark"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, n_links."""
    keyed, settled = _linked(docs, threshold, shared_folder(docs.sparkSession))
    # a key may be hot, its class is one row: such a join is split by Spark
    rows = keyed.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("key")).alias("key")).join(settled, "key", "left")
    return rows.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class: the first by doc_id and text. Rows that repeat both stay once in any case."""
    keyed, settled = _linked(docs, threshold, shared_folder(docs.sparkSession))
    rows = keyed.filter(F.col("doc_id").isNotNull() & F.col("key").isNotNull()).select("doc_id", "mark", "key").distinct().join(settled, "key")
    dropped = rows.filter((F.col("doc_id") != F.col("class_id")) | (F.col("mark") != F.col("first_mark"))).select("doc_id", "mark")
    return without(docs, dropped, keyed, F.md5(F.coalesce("text", F.lit(""))))


#: The same by brute force: the Jaccard similarity of all pairs that share a shingle, and what links reach.
ORACLE_SQL = r"""
WITH RECURSIVE words AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM documents),
shingle AS MATERIALIZED (SELECT DISTINCT r, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s FROM words WHERE doc_id IS NOT NULL),
size AS (SELECT r, count(*) AS n FROM shingle GROUP BY r),
common AS (SELECT x.r AS a, y.r AS b, count(*) AS c FROM shingle x JOIN shingle y ON x.s = y.s AND x.r <> y.r GROUP BY ALL),
link AS MATERIALIZED (SELECT a, b FROM common JOIN size p ON p.r = a JOIN size q ON q.r = b WHERE c >= 0.8 * (p.n + q.n - c)),
reach AS (SELECT r AS a, r AS b FROM words UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
class AS (SELECT reach.a AS r, min(words.doc_id) AS class_id FROM reach JOIN words ON words.r = reach.b GROUP BY reach.a),
links AS (SELECT a AS r, count(*) AS n FROM link GROUP BY a)
SELECT doc_id, class_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links FROM words JOIN class USING (r) LEFT JOIN links USING (r)
"""
