import math
import random
import re

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import FOLDER, docs
from pyspark.sql import functions as F

from tallyhouse.llm import lexical_search as S
from tallyhouse.llm.oracle import all_sql
from tallyhouse.llm.queries import all_queries

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def plain(rows, items, best=50):
    """Every document scored for every item."""
    split = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in rows]
    n_docs, n_terms = sum(bool(w) for _, w in split), sum(len(w) for _, w in split)
    held = {}
    for _, words in split:
        for w in set(words):
            held[w] = held.get(w, 0) + 1
    out = []
    for item, text in items:
        scores = []
        for i, words in split:
            m = 50 + (50 * len(words) * n_docs) // n_terms if words else 0
            total = 0
            for term in set(TERM.findall((text or "").translate(LOWER))):
                if tf := words.count(term):
                    total += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[term] + 1))) * (1_000_000_000 * tf // (1000 * tf + 20 * m))
            if total:
                scores.append((-total, i is not None, i or 0))
        out += [(item, k + 1, i if known else None, -s) for k, (s, known, i) in enumerate(sorted(scores)[:best])]
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def got(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aBZz09é÷ß\x00 ,.-_@[`{~\x7f\n\x85\xa0中", max_size=40))
def test_terms(text):
    assert [t.decode() for t in S.terms_of(text.encode())] == TERM.findall(text.translate(LOWER))


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 5), st.sampled_from([3, 16]))
def test_pruned_search_is_exact(seed, best, bucket):
    rng = np.random.default_rng(seed)
    n, n_terms = 60, 30
    weights = rng.integers(0, 9000, n_terms)
    chosen = [rng.choice(np.arange(1, n_terms), rng.integers(1, 9), replace=False) for _ in range(4)]
    queries = [S.Query(c, weights[c], best) for c in chosen]
    dense = rng.integers(1, 10**6, (n, n_terms)) * (rng.random((n, n_terms)) < rng.random())
    dense[:, 0], dense[:, 1] = 0, np.maximum(dense[:, 1], 1)
    dense[rng.integers(0, n, 20)] = dense[0]
    row, terms = np.nonzero(dense)
    for part in (range(0, 25), range(25, n)):
        inside = (row >= part.start) & (row < part.stop)
        S.search_block(queries, np.arange(n)[part.start : part.stop], terms[inside], dense[row[inside], terms[inside]],
                       np.bincount(row[inside], minlength=n)[part.start : part.stop], n_terms, bucket)
    for c, q in zip(chosen, queries, strict=True):
        scores = dense[:, c] @ weights[c]
        want = sorted((-s, i) for i, s in enumerate(scores.tolist()) if s > 0)[:best]
        assert [(-s, i) for s, i in zip(q.scores.tolist(), q.docs.tolist(), strict=True)] == want


def test_buckets_and_documents_are_passed_over():
    rng = np.random.default_rng(5)
    terms, lengths = np.tile([1, 2, 3], 4000), np.full(4000, 3)
    impact = rng.integers(1, 1000, 12000)
    impact[:150] += 10**6
    query = S.Query(np.array([1, 3]), np.array([700, 20]), 50)
    S.search_block([query], np.arange(4000), terms, impact, lengths, 4, 500)
    rest = S.Bucket(np.arange(3950), terms[150:], impact[150:], lengths[50:], np.full(3950, 1800.0), 4)
    assert set(query.docs.tolist()) == set(range(50)) and not len(rest.candidates(query))
    query.scores = query.scores // 2000
    assert 0 < len(rest.candidates(query)) < 3950


@pytest.mark.parametrize("sizes", [(16_384, 2_048, 500_000), (50, 7, 300)])
def test_query_by_brute_force_and_sql(spark, monkeypatch, sizes):
    for name, size in zip(("BLOCK", "BUCKET", "PASS_TERMS"), sizes, strict=True):
        monkeypatch.setattr(S, name, size)
    con = duckdb.connect()
    rows, items = (con.sql(f"SELECT {k}, text FROM '{FOLDER}/{t}.parquet'").fetchall() for k, t in (("doc_id", "documents"), ("item_id", "benchmark")))
    found = got(all_queries()["op13_lexical_search"](spark, FOLDER))
    assert found == plain(rows, items)
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    assert found == sorted(con.sql(all_sql()["op13_lexical_search"]).fetchall())


def test_nulls_ties_repeated_rows_long_texts_and_names(spark):
    rng = random.Random(2)
    words = [f"W{i}" for i in range(40)]
    texts = [None, "", "w1 w2", "W1, w2", "w1 w2", "?!", " ".join(rng.choices(words, k=90_000)), "é中 w3", *[" ".join(rng.choices(words, k=9)) for _ in range(40)]]
    ids = [1, 2, None, 4, 3, 5, 6, 7, *range(10, 50)]
    df = docs(spark, *texts, ids=ids)
    df = df.unionByName(df.filter("doc_id = 4")).withColumn("n", F.lit("x")).withColumn("terms", F.lit("x")).withColumn("score", F.lit("x"))
    items = [(7, "w1 W2 w2"), (8, None), (9, "?"), (None, "é中, unknown"), (5, "w3"), (5, "w9 w3")]
    queries = spark.createDataFrame(items, "item_id int, text string").withColumn("item", F.lit("x"))
    united = [(7, "w1 w2"), (None, "é中"), (5, "w3 w9")]
    rows = [*zip(ids, texts, strict=True), (4, "W1, w2")]
    assert got(S.search(df, queries)) == plain(rows, united)
    assert got(S.search(df, queries, best=3)) == plain(rows, united, 3)
    assert [r[2] for r in got(S.search(df, queries)) if r[0] == 7 and r[2] in (None, 3, 4)] == [None, 3, 4, 4]
    for d, q in ((df.limit(0), queries), (df, queries.limit(0)), (df.filter("doc_id = 2"), queries)):
        empty = S.search(d, q)
        assert empty.columns == ["item_id", "rank", "doc_id", "score"] and empty.count() == 0
