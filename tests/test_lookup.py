import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyhouse.operators import lookup as L


def test_latest_and_first_keep_nulls_of_the_chosen_row(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, "b"), (1, 3, None), (2, 9, "z")], "k int, id int, v string")
    assert rows(L.latest_by(df, ["k"], "id"), "k", "id", "v") == [("1", "3", None), ("2", "9", "z")]
    assert rows(L.first_by(df, ["k"], "id"), "k", "id", "v") == [("1", "1", None), ("2", "9", "z")]
    assert rows(L.latest_by(df, ["k"], "id", F.col("id") < 3), "k", "id") == [("1", "2")]


def test_max_by_key_and_sums(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 7), (2, "b", 1)], "k int, s string, v int")
    out = L.max_by_key(df, ["k"], {"a": (F.col("s") == "a", "v"), "b": (F.col("s") == "b", "v")})
    assert rows(out, "k", "a", "b") == [("1", "5", "7"), ("2", None, "1")]
    assert rows(L.sum_by(df, ["k"], {"total": "v"}), "k", "total") == [("1", "12.00"), ("2", "1.00")]


def test_dedupe_latest_breaks_ties_by_all_columns(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, None, "c")], "k int, t int, v string")
    for partitions in (1, 3):
        assert rows(L.dedupe_latest(df.repartition(partitions), ["k"], ["t"]), "k", "t", "v") == [("1", "5", "a")]


def test_dedupe_limits_each_key_before_the_shuffle(spark, folder):
    spark.createDataFrame([(1, 5)], "k int, t int").write.parquet(f"{folder}/t")
    plan = L.dedupe_latest(spark.read.parquet(f"{folder}/t"), ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning(k") < plan.index("Partial")


def test_attributes(spark):
    df = spark.createDataFrame(
        [(1, "model", "i1"), (1, "i1", "0.2"), (1, "i2", "0.3"), (1, "x", "i2"), (2, "model", "i9"), (2, "i1", "0.2")],
        "k int, name string, value string")
    assert rows(L.eav(df, ["k"], {"m": "model", "one": "i1"}, "name", "value"), "k", "m", "one") == [("1", "i1", "0.2"), ("2", "i9", "0.2")]
    assert rows(L.eav_indirect(df, "k", "model", "i%", "name", "value"), "k", "parameter_value") == [("1", "0.2")]
    codes = spark.createDataFrame([(1, "i2"), (2, "none")], "k int, code string")
    assert rows(L.eav_by_column(df, codes, "k", "code", "name", "value"), "k", "code", "parameter_value") == [("1", "i2", "0.3")]


@pytest.mark.parametrize("pick, value", [(L.latest_by, "c"), (L.first_by, "a")])
def test_equal_ids_are_decided_by_the_other_columns(spark, pick, value):
    df = spark.createDataFrame([(1, 5, v) for v in "bca"] + [(1, None, "z"), (1, None, "A")], "k int, id int, v string")
    for rows in (df, df.orderBy("v"), df.orderBy(F.desc("v"))):
        assert [r.v for r in pick(rows.repartition(3), ["k"], "id").collect()] == [value]
