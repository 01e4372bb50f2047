import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import FOLDER, docs, given_documents
from pyspark.sql import functions as F

from tallyhouse.llm import sharding
from tallyhouse.llm.queries import all_queries


def least_capacity(sizes, shards):
    def needs(capacity):
        count, left = 1, capacity
        for s in sizes:
            if s > left:
                count, left = count + 1, capacity
            left -= s
        return count
    low, high = max(sizes), sum(sizes)
    return next(c for c in range(low, high + 1) if needs(c) <= shards)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=30), st.integers(1, 8))
def test_even_cuts_keep_the_capacity(sizes, shards):
    tree = sharding.Tree([sharding.Node(i << 4, 4, s, 1) for i, s in enumerate(sizes)])
    capacity = sharding.smallest(lambda c: tree.cuts(c, shards) is not None, 1, sum(sizes))
    assert capacity == least_capacity(sizes, shards)
    cuts = [0, *sharding.even_cuts(tree, capacity, shards), sum(sizes)]
    assert cuts == sorted(cuts) and max(b - a for a, b in zip(cuts, cuts[1:])) == capacity


def dealt(spark, df, shards):
    rows = sharding.sharded(df, F.col("text"), F.octet_length("text"), shards).collect()
    for s in range(shards):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    assert len({(r.text, r.shard) for r in rows}) == len({r.text for r in rows})
    return rows


@pytest.mark.parametrize("shards", [1, 3, 24])
def test_capacity_is_least(spark, shards):
    texts = [f"{i} " * (1 + i * i % 37) for i in range(300)] + ["copy"] * 400
    df = docs(spark, *texts).repartition(5)
    rows = dealt(spark, df, shards)
    order = {r.text: r.g for r in df.select("text", sharding.group_hash(F.col("text")).alias("g")).collect()}
    sizes = {}
    for r in rows:
        sizes[r.text] = sizes.get(r.text, 0) + len(r.text)
    ordered = [sizes[t] for t in sorted(sizes, key=order.get)]
    capacity = least_capacity(ordered, shards)
    filled = [sum(len(r.text) for r in rows if r.shard == s) for s in range(shards)]
    assert {r.capacity for r in rows} == {capacity} == {max(filled)}


def test_hot_group_leaves_the_other_shards_even(spark):
    rows = dealt(spark, docs(spark, *["x" * 30] * 100, *[f"{i:030d}" for i in range(200)]), 10)
    filled = sorted(sum(len(r.text) for r in rows if r.shard == s) for s in range(10))
    assert filled[-1] >= 3000 and filled[0] > 300


def test_nulls_empty_table_and_clashing_names(spark):
    df = docs(spark, None, None, "", "a", ids=[1, None, 2, 2]).withColumn("slot", F.lit("mine")).withColumn("group_hash", F.lit(7))
    rows = sharding.sharded(df, F.col("text"), F.octet_length("text"), 2).collect()
    assert len(rows) == 4 and rows[0].group_hash == 7 and all(isinstance(r.slot, int) for r in rows)
    assert sharding.sharded(df.limit(0), F.col("text"), F.octet_length("text"), 2).count() == 0


def test_files(spark, folder):
    df = sharding.sharded(docs(spark, *[str(i) for i in range(50)]), F.col("text"), F.octet_length("text"), 4)
    sharding.write_shards(df, f"{folder}/shards")
    assert spark.read.parquet(f"{folder}/shards").count() == 50


def test_query(spark):
    rows = all_queries()["op8_minimax_shards"](spark, FOLDER).collect()
    texts = dict(given_documents())
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "bytes", None)
