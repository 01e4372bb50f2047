import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import FOLDER, by_id, docs, given_documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import public_tokenizers
from tallyhouse.llm import bpe_codec as B
from tallyhouse.llm.queries import all_queries

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")
LIBRARY = {name: Tokenizer.from_file(public_tokenizers.path(name)) for name in FILES}
CODECS = {name: B.Codec(name) for name in FILES}


def same(name, text):
    return np.frombuffer(CODECS[name].encode(text), "<i4").tolist() == LIBRARY[name].encode(text, add_special_tokens=False).ids


def plain(symbols, products, base):
    """The leftmost pair of least rank is united until none is left."""
    while True:
        best = min(((p, i) for i in range(len(symbols) - 1) if (p := products.get(symbols[i] * base + symbols[i + 1])) is not None), default=None)
        if best is None:
            return symbols
        p, i = best
        symbols = [*symbols[:i], p, *symbols[i + 2 :]]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=30), st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=10, unique=True))
def test_queue_against_plain_merging(symbols, merges):
    base, products, pairs = 100, {}, {}
    for k, (a, b) in enumerate(merges):
        products[a * base + b], pairs[3 + k] = 3 + k, (a, b)
    assert B.merged(list(symbols), products, pairs, base) == plain(symbols, products, base)


@pytest.mark.parametrize("name", FILES)
def test_ids_are_the_librarys(name):
    for _, text in given_documents():
        assert same(name, text or "")
    for text in ("", " ", "\n\n a  b\t\r\n", "it's I'LL 's", "a<|endoftext|>b <|startoftext|>", "<|endoftext|>", "ÀÉİ ǅ ÿ½²", "α日本 ‍ é",
                 "a\x01\x0bb\x1cc\x85d\xa0e", "x" * 5000, "a.. b,, c.,", "é" * 300, "é ﬁ Σας"):
        assert same(name, text), text


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB'sé.,!?1²  \n\t ́Σ<|>", max_size=30))
def test_ids_of_odd_texts(text):
    assert all(same(name, text) for name in FILES)


def test_capitals_whose_small_letter_is_of_a_later_block():
    for c in map(chr, range(0xA1, 0x250)):
        assert all(same(name, f"a{c}c {c}") for name in FILES), c


def test_pieces_are_kept_up_to_a_bound(monkeypatch):
    monkeypatch.setattr(B, "KEPT_PIECES", 5)
    codec = B.Codec(FILES[0])
    text = " ".join(f"word{i} again" for i in range(50)) + " " + "long" * 30
    assert codec.encode(text) == CODECS[FILES[0]].encode(text) and len(codec.words) <= 5


def test_query(spark):
    rows = by_id(all_queries()["op12_bpe_codec"](spark, FOLDER))
    t = LIBRARY["word_bpe_49k.json"]
    assert len(rows) == len(given_documents())
    for i, text in given_documents():
        ids = t.encode(text or "", add_special_tokens=False).ids
        r = rows[i]
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@pytest.mark.parametrize("name", FILES)
def test_decoding_nulls_names_and_empty_tables(spark, name):
    texts = [None, "", "a<|endoftext|>b", "日本 é", "x y " * 30000, "x", "x"]
    df = docs(spark, *texts, ids=[None, 1, 2, 3, 4, 5, 5]).withColumn("ids", F.lit(1)).withColumn("data", F.lit(2)).withColumn("decoded", F.lit(3))
    out = B.decoded(B.encoded(df, tokenizer=name), tokenizer=name)
    t, rows = LIBRARY[name], out.collect()
    assert len(rows) == len(texts) and set(out.columns) == set(df.columns) and all(r.data == 2 for r in rows)
    for r in rows:
        assert r.ids == t.encode(r.text or "", add_special_tokens=False).ids and r.decoded == t.decode(r.ids, skip_special_tokens=False)
    assert out.limit(0).count() == 0 and B.encoded(df.limit(0)).count() == 0
    part = spark.sql("SELECT CAST(NULL AS array<int>) AS ids UNION ALL SELECT array(200, 201)")
    assert {r.decoded for r in B.decoded(part, tokenizer=name).collect()} == {None, t.decode([200, 201], skip_special_tokens=False)}
