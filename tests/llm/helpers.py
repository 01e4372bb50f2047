"""Small tables and plain versions that the tests compare with."""

from __future__ import annotations

import duckdb

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, *texts, ids=None, source="s"):
    ids = ids or range(len(texts))
    rows = [(i, t, None, source, None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, DOCS)


def given_documents(folder=FOLDER):
    return duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet' ORDER BY doc_id").fetchall()


def by_id(df):
    return {r["doc_id"]: r.asDict(recursive=True) for r in df.collect()}
