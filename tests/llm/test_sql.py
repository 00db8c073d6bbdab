"""The operators' SQL, run by DuckDB, against their results on edge cases."""

import duckdb
import pandas as pd
import pytest

from rangelake.llm import near_duplicates, secret_scan

KEY = "AKIA" + "Q7" * 8
LINE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"


def rows(df):
    return sorted(map(repr, df.toPandas().astype(object).sort_index(axis=1).to_dict("records")))


def oracle(sql, docs):
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text"]).astype({"doc_id": "Int64", "text": "string"}))
    return sorted(map(repr, con.sql(sql).df().astype(object).sort_index(axis=1).to_dict("records")))


@pytest.mark.parametrize(
    "docs",
    [
        [],
        [(1, None), (2, ""), (3, "?!")],
        [(1, f'Password: "short" token=key pass {KEY}{KEY} x'), (2, f"API_KEY = 'abcdef' é\U0001f600 {'0f' * 12} {'0f' * 11}")],
        [(4, f"é secret=secret=abcdefg,{KEY}"), (4, f"é secret=secret=abcdefg,{KEY}"), (5, "a" * 30 + KEY), (6, "password='x'token:yyyyyy" + "z" * 5000)],
        [(7, "ghp_" + "Ab9" * 12 + " AIza" + "x-_" * 12 + "\n-----BEGIN RSA PRIVATE KEY-----"), (8, "token=" + "ghp_" + "Ab9" * 12)],
    ],
)
def test_secret_scan(spark, docs):
    assert rows(secret_scan.secret_scan(spark.createDataFrame(docs, "doc_id long, text string"))) == oracle(secret_scan.ORACLE_SQL, docs)


@pytest.mark.parametrize(
    "docs",
    [
        [],
        [(1, None), (2, ""), (3, "?!"), (3, "?!")],
        [(1, "a b"), (2, "A, b!"), (3, "a b c"), (9, "Été x"), (8, "été X")],
        [(3, LINE), (5, LINE), (5, LINE + " seventeen"), (8, LINE + " seventeen eighteen"), (2, LINE + " " + LINE), (3, LINE)],
        [(i, " ".join(f"w{j}" for j in range(i, i + 40))) for i in range(6)],
    ],
)
def test_near_duplicates(spark, docs):
    assert rows(near_duplicates.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))) == oracle(near_duplicates.ORACLE_SQL, docs)
