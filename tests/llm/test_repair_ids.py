import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import FOLDER, by_id, docs, given_documents
from tokenizers import Tokenizer

import public_tokenizers
from tallyhouse.llm import repair_ids as R
from tallyhouse.llm import tokens
from tallyhouse.llm.queries import all_queries


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), max_size=60), max_size=12), st.integers(1, 3))
def test_round_trip(texts, least):
    R.LEAST_COUNT, held = least, R.LEAST_COUNT
    try:
        ids = [np.array([*t, 1], np.uint16) for t in texts]
        block = R.Block(R.write_block([None if i % 3 == 2 else i for i in range(len(ids))], ids))
    finally:
        R.LEAST_COUNT = held
    assert [(d, x.tolist()) for d, _, x in block.documents()] == [(None if i % 3 == 2 else i, x.tolist()) for i, x in enumerate(ids)]
    flat = np.concatenate(ids).tolist() if ids else []
    for i, x in enumerate(ids):
        assert block.document(i).tolist() == x.tolist()
    for start in range(0, len(flat), 7):
        n = min(9, len(flat) - start)
        assert block.part(start, n).tolist() == flat[start : start + n]
    for i, n in enumerate(block.lengths.tolist()):
        assert len(R.expand(np.array([block.vocabulary + i], np.uint16), block.rules, block.vocabulary)) == n


def test_repetitive_ids_shrink():
    ids = [np.array([*np.tile(np.arange(100, 116), 200), 1], np.uint16)]
    block = R.Block(R.write_block([1], ids))
    assert len(block.rules) > 8 and len(block.symbols) < 3200 / 10 and len(np.unique(block.symbols)) > 1


def test_no_pair_is_left():
    rng = np.random.default_rng(1)
    flat = rng.zipf(1.4, 20_000).clip(max=60).astype(np.uint16)
    flat[::97] = 1
    for given_ids in (flat, np.full(5000, 7, np.uint16), np.array([1] * 50, np.uint16), np.array([3], np.uint16)):
        rules, symbols = R.compress(given_ids, 1, 100)
        assert R.expand(symbols, rules, 100).tolist() == given_ids.tolist()
        usable = (symbols[:-1] != 1) & (symbols[1:] != 1)
        usable[R.odd_places(symbols)] = False
        keys, count = np.unique(np.stack([symbols[:-1], symbols[1:]])[:, usable], axis=1, return_counts=True)
        assert not len(count) or count.max() < R.LEAST_COUNT
    assert len(R.compress(np.full(5000, 7, np.uint16), 1, 100)[1]) < 20


def test_ids_beyond_the_vocabulary_are_refused():
    with pytest.raises(ValueError):
        R.write_block([1], [np.array([49_408, 1], np.uint32)])


class Counting:
    """A core that counts the words handed to it."""

    def __init__(self, core):
        self.core, self.words = core, 0

    def encode_to_numpy(self, text):
        self.words += text.count(tokens.END)
        return self.core.encode_to_numpy(text)


def test_recurring_words_are_encoded_once(monkeypatch):
    encoder = tokens.Encoder(R.TOKENIZER, False)
    monkeypatch.setattr(encoder, "core", Counting(encoder.core))
    texts = ["Unheard wordishly, it's", "wordishly unheard", "", "日本 unheard"] * 300
    ids = list(encoder.each(texts))
    assert ids[:4] == [np.array(encoder.library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts[:4]]
    assert ids == ids[:4] * 300 and encoder.core.words == 5


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aB'sSérvelLdtm.,!1² \n\tΣƁ", max_size=12), max_size=8), st.integers(1, 20))
def test_texts_taken_together_have_the_librarys_ids(texts, chunk):
    tokens.CHUNK, held = chunk, tokens.CHUNK
    try:
        encoder = tokens.encoder(R.TOKENIZER)
        got = [np.frombuffer(x, "<u4").tolist() for x in encoder.each(texts)]
    finally:
        tokens.CHUNK = held
    assert got == [encoder.library.encode(t, add_special_tokens=False).ids for t in texts]


def test_query(spark, monkeypatch):
    monkeypatch.setattr(R, "BLOCK_IDS", 5000)
    rows = by_id(all_queries()["op4_repair_ids"](spark, FOLDER))
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start = 0
    for i, text in given_documents():
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        assert (rows[i]["start"], rows[i]["n_tokens"], rows[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(rows) == len(given_documents())


def test_nulls_repeated_ids_and_empty_tables(spark, folder):
    df = docs(spark, "b a", None, "", "a b", "a b", "long " * 30000, ids=[3, None, 1, 2, 2, 9]).repartition(3)
    R.write(df, f"{folder}/ids")
    rows = sorted(R.read(spark, f"{folder}/ids").collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 2, 2, 3, 9]
    at = 0
    for r in rows:
        assert r.start == at
        at += len(r.ids) // 4
    R.write(df.limit(0), f"{folder}/none")
    assert R.read(spark, f"{folder}/none").count() == 0
