"""The pipeline, and that every query is there."""

from __future__ import annotations

import inspect

import corpus_pipeline
import __spark_entry__ as entry
from tests.llm.test_operators import ITEMS, WORDS, frame, prose


def test_queries_are_registered():
    names = entry.queries()
    assert "pipeline" in names and sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()) == list(range(1, 11))
    assert set(entry.oracle_sql()) <= set(names)


def test_pipeline(spark, tmp_path):
    english, other = WORDS, ["".join(reversed(w)) for w in WORDS]
    texts = [prose(i, 120, english if i % 2 else other) for i in range(80)]
    langs = ["xx" if i % 2 else "yy" for i in range(80)]
    near = texts[3].split()
    near[60] = "changed"
    texts += [texts[0], texts[1].replace(" ", "\n"), " ".join(near), texts[5] + " " + ITEMS[0][1], "1234 ###", None, ""]
    langs += ["yy", None, "xx", "xx", None, None, "xx"]
    frame(spark, texts, langs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == set(range(80))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), str(tmp_path)).columns == docs.columns
    assert [len(inspect.signature(f).parameters) for _, f in corpus_pipeline.STAGES] == [3] * 5
