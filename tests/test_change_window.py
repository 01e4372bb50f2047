import pytest
from pyspark.sql import functions as F

from tallyhouse.functions.change_window import ChangeWindow, changed, changed_keys, recent

W = ChangeWindow("1998-01-01 00:00:00", "1998-02-01 00:00:00")


def stamps(spark, *pairs):
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "id int, a string, b string").selectExpr(
        "id", "cast(a as timestamp_ntz) a", "cast(b as timestamp_ntz) b")


def ids(df):
    return sorted(r[0] for r in df.select("id").collect())


def test_start_is_out_end_is_in_and_null_needs_the_other(spark):
    df = stamps(spark, ("1998-01-01", None), ("1998-02-01", None), (None, "1998-01-15"), (None, None), ("1998-01-01 00:00:01", "1990-01-01"))
    assert ids(df.filter(changed(W, "a", "b"))) == [1, 2, 4]


def test_changed_keys_of_two_tables(spark):
    df = stamps(spark, ("1998-01-15", "1990-01-01"), ("1990-01-01", "1998-01-15"), ("1990-01-01", "1990-01-01"))
    assert ids(changed_keys(W, "id", (df.select("id", "a"), ["a"]), (df.select("id", "b"), ["b"]))) == [0, 1]


def test_recent_compares_a_date_with_the_start(spark):
    df = stamps(spark, ("1998-01-01", None), ("1997-12-31", "1998-01-01"), ("1997-12-31", None)).withColumn("a", F.col("a").cast("date"))
    assert ids(df.filter(recent(W, "a", "b"))) == [0, 1]


def test_window_reaches_the_parquet_scan(spark, folder):
    stamps(spark, ("1998-01-15", None)).write.parquet(f"{folder}/t")
    plan = spark.read.parquet(f"{folder}/t").filter(changed(W, "a", "b"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(And(GreaterThan(a" in plan


def test_an_inverted_window_is_refused():
    with pytest.raises(ValueError, match="after its end"):
        ChangeWindow("2024-01-30 00:00:00", "2000-01-01 00:00:00")
