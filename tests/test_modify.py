import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyhouse.operators import modify as M
from tallyhouse.operators.presence import mark_present

T = "k int, a string, b string, own string"


def target(spark):
    return spark.createDataFrame([(1, "a1", "b1", "o1"), (2, "a2", "b2", "o2"), (3, "a3", "b3", None)], T)


def source(spark, *data):
    return spark.createDataFrame(data or [(2, None, "B2"), (4, "A4", "B4")], "k int, a string, b string")


def test_merge_updates_with_nulls_inserts_and_keeps(spark):
    for small in (False, True):
        out = M.merge_upsert(target(spark), source(spark), ["k"], insert_only=["b"], small_source=small, op_column="op")
        assert rows(out, "k", "a", "b", "own", "op") == [
            ("1", "a1", "b1", "o1", "keep"), ("2", None, "b2", "o2", "update"), ("3", "a3", "b3", None, "keep"), ("4", "A4", "B4", None, "insert"),
        ]


def test_merge_twice_changes_nothing_more(spark):
    once = M.merge_upsert(target(spark), source(spark), ["k"])
    twice = M.merge_upsert(once, source(spark), ["k"])
    assert rows(once, *once.columns) == rows(twice, *twice.columns)


def test_duplicate_source_keys(spark):
    twice = source(spark, (2, "x", "1"), (2, "y", "2"))
    with pytest.raises(Exception, match="several rows for one k"):
        M.merge_upsert(target(spark), twice, ["k"]).collect()
    out = M.merge_upsert(target(spark), twice, ["k"], on_duplicate="latest", order_by=["b"])
    assert ("2", "y", "2", "o2") in rows(out, "k", "a", "b", "own")


def test_null_source_key_raises_and_null_target_key_is_kept(spark):
    with pytest.raises(Exception, match="merge key k is null"):
        M.merge_upsert(target(spark), source(spark, (None, "x", "y")), ["k"]).collect()
    with_null = target(spark).union(spark.createDataFrame([(None, "n", "n", "n")], T))
    assert (None, "n", "n", "n") in rows(M.merge_upsert(with_null, source(spark), ["k"]), "k", "a", "b", "own")


def test_composite_key(spark):
    t = spark.createDataFrame([(1, "x", "old"), (1, "y", "old")], "a int, b string, v string")
    s = spark.createDataFrame([(1, "y", "new"), (2, "x", "new")], "a int, b string, v string")
    assert rows(M.merge_upsert(t, s, ["a", "b"]), "a", "b", "v") == [("1", "x", "old"), ("1", "y", "new"), ("2", "x", "new")]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    before=st.dictionaries(st.integers(0, 8), st.one_of(st.none(), st.text("ab", max_size=2)), max_size=8),
    change=st.dictionaries(st.integers(0, 12), st.one_of(st.none(), st.text("cd", max_size=2)), max_size=8),
    small=st.booleans(),
)
def test_merge_is_a_dictionary_update(spark, before, change, small):
    t = spark.createDataFrame(list(before.items()), "k int, v string")
    s = spark.createDataFrame(list(change.items()), "k int, v string")
    out = {r["k"]: r["v"] for r in M.merge_upsert(t, s, ["k"], small_source=small).collect()}
    assert out == {**before, **change}


def test_merge_shuffles_the_target_once_for_all_joins_on_the_key(spark, folder):
    for name, df in (("t", target(spark)), ("s", source(spark)), ("x", source(spark).withColumnRenamed("a", "z").drop("b"))):
        df.write.parquet(f"{folder}/{name}")
    read = {n: spark.read.parquet(f"{folder}/{n}") for n in "tsx"}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = M.merge_upsert(read["t"], read["s"], ["k"]).join(read["x"], "k", "left")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 32 << 20)
    # target, its keys, the source for updates and for inserts, and the joined table
    assert plan.count("Exchange hashpartitioning") == 5


def test_update_where_ignores_null_conditions(spark):
    out = M.update_where(target(spark), F.col("own") == "o1", {"a": F.lit("new")}, "hit")
    assert rows(out, "k", "a", "hit") == [("1", "new", "True"), ("2", "a2", "False"), ("3", "a3", "False")]


def test_update_from_takes_the_latest_of_several_rows(spark):
    changes = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (9, 1, "z"), (None, 1, "n")], "k int, t int, v string")
    out = M.update_from(target(spark), changes, ["k"], {"a": F.col("src_v")}, order_by=["t"], flag="hit")
    assert rows(out, "k", "a", "hit") == [("1", "y", "True"), ("2", "a2", "False"), ("3", "a3", "False")]
    with pytest.raises(Exception, match="several rows"):
        M.update_from(target(spark), changes, ["k"], {"a": F.col("src_v")}).collect()


def test_purge_and_archive(spark):
    landing = spark.createDataFrame([(1,)], "k int")
    archive = target(spark).filter("k = 2")
    kept, removed = M.purge(target(spark), landing, ["k"], archive)
    assert rows(kept, "k") == [("1",)]
    assert rows(removed, "k") == [("3",)]
    assert rows(M.purge(target(spark), landing, ["k"], archive_where=F.col("k") < 3)[1], "k") == [("2",)]


def test_append_and_delete(spark):
    assert rows(M.append_rows(target(spark), source(spark)).filter("k = 4"), "k", "own") == [("4", None)]
    assert rows(M.delete_keys(target(spark), source(spark), ["k"]), "k") == [("1",), ("3",)]


def test_divergence_is_blind_to_nulls_unless_null_safe(spark):
    df = spark.createDataFrame([(1, "a", "b"), (2, None, "b"), (3, None, None), (4, "a", "a")], "k int, x string, y string")
    pair = [(F.col("x"), F.col("y"))]
    assert rows(df.filter(M.diverges(pair)), "k") == [("1",)]
    assert rows(df.filter(M.diverges(pair, null_safe=True)), "k") == [("1",), ("2",)]


def test_mark_present(spark):
    twice = source(spark, (2, "x", "1"), (2, "y", "2"))
    assert rows(mark_present(target(spark), twice, ["k"], "there"), "k", "there") == [("1", "False"), ("2", "True"), ("3", "False")]
