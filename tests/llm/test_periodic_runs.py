import hashlib
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import FOLDER, by_id, docs, given_documents
from pyspark.sql import functions as F

import pytest
from tallyhouse.llm import periodic_runs as R
from tallyhouse.llm.queries import all_queries


def plain(words, power=4, length=6):
    """All runs, by comparing the words with themselves one period on, for every period."""
    n, out = len(words), []
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(length, power * q) and not any(s <= i and j + q <= s + m for s, m, p in out if p < q):
                out.append((i, j + q - i, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_kept(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def plain_words(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


@settings(max_examples=600, deadline=None)
@given(st.one_of(
    st.lists(st.sampled_from(["a", "b"]), max_size=60),
    st.lists(st.tuples(st.text("abc", min_size=1, max_size=4), st.integers(1, 9)), max_size=6).map(lambda p: [c for w, n in p for c in w * n]),
), st.sampled_from([(4, 6), (2, 2), (3, 1), (2, 9)]))
def test_runs_are_all_runs(letters, least):
    words = [c.encode() for c in letters]
    runs = R.runs_of(words, *least)
    assert runs == plain(words, *least)
    assert R.collapsed(words, runs) == plain_kept(words, runs)


def test_many_words_and_deep_prefixes():
    words = [str(i).encode() for i in range(3000)] + [b"x"] * 4000 + [str(i % 700).encode() for i in range(5000)] + [b"x"] * 900
    assert R.runs_of(words) == [(3000, 4000, 1), (7000, 5000, 700), (12000, 900, 1)]


def test_query(spark):
    rows = by_id(all_queries()["op11_periodic_runs"](spark, FOLDER))
    given_rows = given_documents()
    assert len(rows) == len(given_rows)
    found = 0
    for i, text in given_rows:
        words = plain_words(i, text)
        runs, r = plain(words), rows[i]
        found += bool(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None,) * 3
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(b" ".join(plain_kept(words, runs))).hexdigest()
    assert found > 10


def test_nulls_long_texts_names_and_empty_tables(spark):
    long = "é a b " * 30000
    df = docs(spark, None, "", "a " * 6, long, long, "a b", ids=[None, 1, 2, 3, 3, 4])
    df = df.withColumn("periodic_runs", F.lit(1)).withColumn("runs", F.lit(2)).withColumn("words", F.lit(3))
    rows = R.with_runs(df).collect()
    got = {(r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed, r.periodic_runs) for r in rows}
    assert len(rows) == 6 and got == {
        (None, 0, (), "", 1), (1, 0, (), "", 1), (2, 6, ((0, 6, 1),), "a", 1), (3, 90000, ((0, 90000, 3),), "é a b", 1), (4, 2, (), "a b", 1)}
    assert R.with_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        R.with_runs(df, power=1)
    changed = df.select("doc_id", R.stretched().alias("text"))
    assert {r.doc_id for r in changed.collect()} == {None, 1, 2, 3, 4}
