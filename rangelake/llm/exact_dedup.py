"""Exact dedup by a heavy-hitter split.

Texts are equal when identical after each run of white space (space, tab to carriage return) becomes one space; the
SHA-256 of that text stands for it. A Misra-Gries sketch finds the digests that may hold more than 1/(k+1) of the rows,
an exact count verifies them, and the winners (at most k rows) are broadcast, so that their rows are settled where they
are read. All other digests, none of which is hot, go through an ordinary shuffled aggregate and join.

Defined cases: a null text counts as empty. A null doc_id never is the id that stays unless a group has no other, and
its row is not marked kept. Rows that repeat both doc_id and text belong to the group and share its verdict. A doc_id
may stand at several texts: rows are judged, not ids. An empty table gives an empty result. Other columns of the input
are ignored here and carried along by ``drop_duplicates``, which keeps one row of each group, whatever repeats.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rangelake.llm.shared import cut, shared_folder, text_or_empty, without

#: Counters of the sketch, and so the most rows that are broadcast.
COUNTERS = 4096


def normalised(text: Column) -> Column:
    """Each run of white space as one space. Single spaces, which stay as they are, aren't matched."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def prune(counters: dict, k: int) -> dict:
    """Misra-Gries: with more than k counters, take the (k+1)-th largest count off all and keep what is positive."""
    if len(counters) <= k:
        return counters
    off = sorted(counters.values(), reverse=True)[k]
    return {d: n - off for d, n in counters.items() if n > off}


def sketch(batches: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    counters: dict = {}
    for batch in batches:
        for d, n in Counter(batch["digest"]).items():
            counters[d] = counters.get(d, 0) + n
        counters = prune(counters, k)
    yield pd.DataFrame({"digest": list(counters), "n": pd.Series(list(counters.values()), dtype="int64")})


def frequent(digests: DataFrame, k: int) -> list:
    """Digests that may hold over 1/(k+1) of all rows: the tasks' sketches are added up and pruned once more."""
    parts = digests.select("digest").mapInPandas(lambda b: sketch(b, k), "digest binary, n long")
    top = parts.groupBy("digest").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "digest").limit(k + 1).collect()
    return list(prune({bytes(r["digest"]): r["n"] for r in top}, k))


def exact_dedup(docs: DataFrame, k: int = COUNTERS, folder: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark)
    digest = F.unhex(F.sha2(normalised(text_or_empty()), 256)).alias("digest")
    digests = cut(docs.select("doc_id", digest), "digests", folder)
    stats = (F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))

    candidates = spark.createDataFrame([(d,) for d in frequent(digests, k)], "digest binary")
    counted = digests.join(F.broadcast(candidates), "digest", "left_semi").groupBy("digest").agg(*stats).collect()
    rows = digests.count()
    winners = spark.createDataFrame([tuple(r) for r in counted if r["group_size"] * (k + 1) > rows], "digest binary, keep_id long, group_size long")

    heavy = digests.join(F.broadcast(winners), "digest")
    light = digests.join(F.broadcast(winners), "digest", "left_anti")
    settled = heavy.unionByName(light.join(light.groupBy("digest").agg(*stats), "digest"))
    return settled.select("doc_id", "keep_id", "group_size", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_duplicates(docs: DataFrame, k: int = COUNTERS) -> DataFrame:
    """``docs`` with one row of each text: that of the smallest doc_id; one without doc_id if there is no other."""
    verdicts = cut(exact_dedup(docs, k).select("doc_id", "keep_id", F.col("text_sha256").alias("mark")), "verdicts")
    dropped = verdicts.filter(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("doc_id", "mark").distinct()
    return without(docs, dropped, verdicts, F.sha2(normalised(text_or_empty()), 256))


ORACLE_SQL = r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM n
"""
