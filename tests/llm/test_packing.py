import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import FOLDER, docs, given_documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import public_tokenizers
from tallyhouse.llm import packing, tokens
from tallyhouse.llm.queries import all_queries


def library(name, special_as_text=False):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = special_as_text
    return lambda text: t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_the_librarys(name):
    each = [(library(name, s), tokens.encoder(name, s).ids) for s in (False, True)]
    same = lambda t: all(np.frombuffer(mine(t), "<u4").tolist() == plain(t) for plain, mine in each)
    for _, text in given_documents():
        assert same(text or "")
    for text in ("", " ", "\n\n a  b\t\r\n", "it's I'LL 's", "<|endoftext|>a", "ÀÉİ ǅ ÿ½²", "α日本 ‍ é", "a\x0bb\x1cc\x85d\xa0e", "x" * 5000, "a.. b,, c.,"):
        assert same(text), text


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aB'sé.,!?1²  \n\t ́Σ", max_size=30))
def test_ids_of_odd_texts(text):
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        assert np.frombuffer(tokens.encoder(name).ids(text), "<u4").tolist() == library_ids(name, text)


def test_capitals_whose_small_letter_is_of_a_later_block():
    for c in map(chr, range(0xA1, 0x250)):
        for text in (c, f"a{c}c {c}"):
            assert np.frombuffer(tokens.encoder("word_bpe_49k.json").ids(text), "<u4").tolist() == library_ids("word_bpe_49k.json", text)


LIBRARY = {}


def library_ids(name, text):
    if name not in LIBRARY:
        LIBRARY[name] = library(name)
    return LIBRARY[name](text)


def test_cuts():
    assert packing.cuts(1, 4) == [(0, 1)] and packing.cuts(4, 4) == [(0, 4)]
    assert packing.cuts(10, 4) == [(0, 2), (2, 4), (6, 4)] and packing.cuts(8, 4) == [(0, 4), (4, 4)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 9), max_size=60))
def test_each_piece_goes_where_the_squares_become_least(sizes):
    state, free = packing.SumOfSquares(10), {}

    def squares(gaps):
        return sum(gaps.count(g) ** 2 for g in set(gaps) if g)

    for n in sizes:
        gaps = list(free.values())
        options = [squares([*gaps[:i], g - n, *gaps[i + 1 :]]) for i, g in enumerate(gaps) if g >= n] or [squares([*gaps, 10 - n])]
        sequence, offset = state.place(n)
        assert offset == 10 - free.get(sequence, 10)
        free[sequence] = free.get(sequence, 10) - n
        assert free[sequence] >= 0 and squares(list(free.values())) == min(options)


def check(rows, capacity=1024):
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_query(spark, folder):
    rows = all_queries()["op1_packing"](spark, folder).collect()
    total = sum(r.length for r in rows)
    assert check(rows) <= 1.004 * -(-total // 1024) + 1
    plain, found = library("byte_bpe_50k.json"), {}
    for r in rows:
        found.setdefault(r.doc_id, []).append(r)
    for i, text in given_documents(folder):
        ids = np.array([*plain(text or ""), 2], "<u4")
        parts = sorted(found[i], key=lambda r: r.piece)
        assert [(r.start, r.length) for r in parts] == packing.cuts(len(ids), 1024)
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in parts)


def test_nulls_repeated_rows_and_empty_tables(spark):
    df = docs(spark, None, "", "a b " * 40000, "x", "x", ids=[None, 1, 2, 3, 3])
    rows = packing.packed(df).collect()
    check(rows)
    by = sorted((r.doc_id or 0, r.piece, r.length, len(r.ids) // 4) for r in rows)
    assert by[0] == (0, 0, 1, 1) and by[1] == (1, 0, 1, 1) and sum(x[2] for x in by if x[0] == 2) > 80000
    assert sum(r.doc_id == 3 for r in rows) == 2
    assert packing.packed(df.limit(0)).count() == 0


def test_several_groups_and_other_columns(spark):
    df = spark.range(500).selectExpr("id % 97 + 1 AS length", "id", "'mine' AS ids")
    rows = packing.pack(df, capacity=100, group_pieces=60).collect()
    assert len(rows) == 500 and check(rows, 100) >= 500 * 49 / 100 and len({r.sequence_id >> 40 for r in rows}) > 3


def test_unfit_lengths_and_clashing_names(spark):
    df = spark.sql("SELECT * FROM VALUES (1L, 5L), (2L, NULL), (3L, 0L), (4L, 101L), (5L, 100L) AS t(offset, length)")
    rows = sorted(packing.pack(df.withColumn("id", df["offset"]), capacity=100).collect(), key=lambda r: r.id)
    assert [(r.id, r.sequence_id is None, r.offset) for r in rows] == [(1, False, 0), (2, True, None), (3, True, None), (4, True, None), (5, False, 0)]
    wide = docs(spark, "a", None).withColumn("row", F.lit(1)).withColumn("ids", F.lit("x"))
    assert sorted(r.length for r in packing.packed(wide).collect()) == [1, 2]
